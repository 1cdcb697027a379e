"""The original jobs run on invented files in their original layouts
(quoted CSVs, header-less invoices, county JSON, prose files, labels plus
a positional distance file)."""

import datetime as dt
import json

import pytest

from quarry.plans import bakery, jobs

D = dt.date

CUSTOMERS = """Id, LastName, FirstName
1, 'DOMKOWSKI', 'ALMETA'
 2, 'SMITH', 'ANN'
3, 'SMITH', 'ANN'
4, 'O'HARA', 'BO'
5, 'LONELY', 'NO'
"""
GOODS = """Id, Flavor, Food, Price
'20-BC-C-10', 'Chocolate', 'Cake', 4.99
'20-BC-C-11', 'Chocolate', 'Eclair', 5.00
'20-BC-C-12', 'Chocolate', 'Tart', 3.25
'70-GON', 'Gongolais', 'Cookie', 1.15
'45-CH', 'Chocolate', 'Cookie', 1.25
'90-APP', 'Apple', 'Tart', 3.50
"""
RECEIPTS = """RecieptNumber, Date, CustomerId
100, '3-Oct-2007', 2
101, '03-Oct-2007', 2
102, '3-Oct-2007', 4
103, '15-Oct-2007', 3
104, '15-Oct-2007', 2
105, '16-Oct-2007', 1
106, '31-Oct-2007', 4
107, '1-Nov-2007', 1
108, '2-Feb-2008', 4
"""
ITEMS_ROWS = [(100, 1, "45-CH"), (100, 2, "45-CH"), (101, 1, "20-BC-C-10"), (102, 1, "70-GON"),
              (103, 1, "20-BC-C-12"), (106, 1, "45-CH"), (107, 1, "45-CH"), (108, 1, "70-GON")]
ITEMS_ROWS += [(104, i, "90-APP") for i in range(2, 13)]   # 11 tarts on 15 Oct (+1 chocolate tart)
ITEMS_ROWS += [(105, i, "90-APP") for i in range(1, 11)]   # 10 tarts on 16 Oct


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("shop")
    (base / "customers.csv").write_text(CUSTOMERS)
    (base / "goods.csv").write_text(GOODS)
    (base / "reciepts.csv").write_text(RECEIPTS)
    (base / "items.csv").write_text("Reciept, Ordinal, Item\n" + "".join(
        f"{r}, {o}, '{g}'\n" for r, o, g in ITEMS_ROWS))
    return bakery.load(spark, str(base))


def test_bakery_queries(shop):
    assert [tuple(r) for r in bakery.cheap_items(shop).collect()] == [
        ("Chocolate", "Cake", 4.99), ("Chocolate", "Tart", 3.25), ("Chocolate", "Cookie", 1.25)]
    assert [tuple(r) for r in bakery.customers_on_day(shop).collect()] == [("BO", "O'HARA"), ("ANN", "SMITH")]
    # 3 Oct: SMITH ANN twice (ids 2); 15 Oct: SMITH ANN via ids 2 and 3 (namesakes merge)
    assert [(r.day, r.day_text) for r in bakery.repeat_buyer_days(shop).collect()] == [
        (D(2007, 10, 3), "03-Oct-2007"), (D(2007, 10, 15), "15-Oct-2007")]
    # ALMETA: 16 Oct, 1 Nov; Gongolais cookie: 3 Oct, 2 Feb 2008 (any year)
    assert [r.day for r in bakery.days_customer_or_product(shop).collect()] == [
        D(2007, 10, 3), D(2007, 10, 16), D(2007, 11, 1), D(2008, 2, 2)]
    # cookies in October: 2 x 1.25 (3 Oct) + 1.15 (3 Oct) + 1.25 (31 Oct); 1 Nov excluded
    assert bakery.revenue_in_month(shop).first().revenue == pytest.approx(2 * 1.25 + 1.15 + 1.25)
    assert [(r.day, r.n_items) for r in bakery.busy_days(shop).collect()] == [(D(2007, 10, 15), 12)]
    spent = {(r.LastName, r.FirstName): r.TotalSpent for r in bakery.spend_per_customer(shop).collect()}
    assert spent[("SMITH", "ANN")] == pytest.approx(2 * 1.25 + 4.99 + 3.25 + 11 * 3.50)
    assert ("LONELY", "NO") not in spent
    assert [tuple(r) for r in bakery.most_popular_product(shop).collect()] == [("Apple", "Tart", 21)]


def test_bakery_strict_load_fails_on_bad_value(spark, tmp_path):
    for name, text in (("customers.csv", CUSTOMERS + "6, NOQUOTE, 'X'\n"), ("goods.csv", GOODS),
                       ("reciepts.csv", RECEIPTS), ("items.csv", "Reciept, Ordinal, Item\n")):
        (tmp_path / name).write_text(text)
    with pytest.raises(Exception):
        bakery.load(spark, str(tmp_path)).customers.collect()
    lenient = bakery.load(spark, str(tmp_path), strict=False)
    assert lenient.customers.filter("LastName IS NULL OR CId = 6").count() == 0
    bad = lenient.rejects.collect()
    assert [r.file for r in bad] == ["customers.csv"] and "NOQUOTE" in bad[0].line


def test_bakery_aggregates_before_the_joins(spark, shop):
    for query in (bakery.busy_days, bakery.spend_per_customer, bakery.most_popular_product):
        plan = query(shop)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.rindex("Aggregate") > plan.index("Join")  # one lies below the outermost join


def test_invoice_rows_keep_their_own_positions_and_bad_values_are_told(spark, tmp_path):
    wide = 'S6,01/05/2015,Polk,12,extra,more,"Rum ""Old""",Vodka,1,30.25'
    (tmp_path / "inv.csv").write_text("\n".join([*INVOICES, wide]) + "\n")
    counties = [{"id": "1", "county": "Polk County", "population": "10"}]
    (tmp_path / "c.json").write_text(json.dumps(counties, indent=1))
    args = (spark, str(tmp_path / "inv.csv"), str(tmp_path / "c.json"))
    assert {r.county: r.total for r in jobs.sales_per_head(*args).collect()}["Polk"] == pytest.approx(120.5 + 30.25 + 30.25)
    last = jobs._invoices(spark, args[1]).filter("line LIKE 'S6%'").first()
    assert (last.text1, last.text2, last.sales) == ('Rum "Old"', "Vodka", 30.25)
    (tmp_path / "inv.csv").write_text("\n".join([*INVOICES, "S7,01/05/2015,Polk,12,Gin,Gin,1,$5.00", "short,row"]) + "\n")
    (tmp_path / "c.json").write_text(json.dumps([*counties, {"id": "2", "county": "Lee County", "population": "n/a"}], indent=1))
    with pytest.raises(Exception, match="not an invoice with an amount|not a county with a population"):
        jobs.sales_per_head(*args).collect()
    out, rejects = jobs.sales_per_head(*args, strict=False)
    assert {r.county: r.total for r in out.collect()}["Polk"] == pytest.approx(150.75)
    assert sorted((r.source, r.line[:5]) for r in rejects.collect()) == [
        ("counties", '{"id"'), ("invoices", "S7,01"), ("invoices", "short")]


def test_same_named_files_of_two_folders_are_two_documents(spark, tmp_path):
    for folder in ("x", "y"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "same.txt").write_text("one two three\n")
    pair, = jobs.document_similarity(spark, [str(tmp_path / "x"), str(tmp_path / "y")], threshold=0.01).collect()
    assert (pair.doc_a, pair.doc_b) == ("same.txt", "same.txt") and pair.path_a != pair.path_b


INVOICES = [
    'S1,01/02/2015,Polk,12,"Rum, Spiced",Captain Rum,12,120.5',
    "S2,01/02/2015,Polk,12,Vodka 80 Proof,Rum Vodka Mix,6,30.25",
    "S3,01/03/2015,O'Brien,4,Imported Vodka,Smirnoff,2,22.0",
    "S4,01/03/2015,Story,9,Whiskey,Drum Kit,1,9.99",
    "S5,01/04/2015,Lee,3,Gin,Dry Gin,4,40.0",
]


def test_sales_per_head_and_keywords(spark, tmp_path):
    (tmp_path / "inv.csv").write_text("\n".join(INVOICES) + "\n")
    (tmp_path / "c.json").write_text(json.dumps([
        {"id": "1", "county": "Polk County", "population": "474,045"},
        {"id": "2", "county": "OBrien County", "population": "14 020"},
        {"id": "3", "county": "Adams County", "population": "3,645"}], indent=1))
    out = {r.county: r for r in jobs.sales_per_head(spark, str(tmp_path / "inv.csv"),
                                                    str(tmp_path / "c.json")).collect()}
    assert out["Polk"].total == pytest.approx(150.75) and out["OBrien"].population == 14020
    assert out["Lee"].per_head is None and out["Adams"].per_head == 0.0
    inf = {r.county: r.per_head for r in jobs.sales_per_head(
        spark, str(tmp_path / "inv.csv"), str(tmp_path / "c.json"), on_zero="infinity").collect()}
    assert inf["Lee"] == float("inf")
    r = jobs.keyword_correlation(spark, str(tmp_path / "inv.csv")).first()
    # per county (rum, vodka): Polk (2, 1), O'Brien (0, 1), Story (1, 0) -- the quoted comma
    # stays inside "Rum, Spiced", so positions from the end are right
    xs, ys = [2, 0, 1], [1, 1, 0]
    mx, my = sum(xs) / 3, sum(ys) / 3
    cov = sum((a - mx) * (b - my) for a, b in zip(xs, ys)) / 3
    sx = (sum((a - mx) ** 2 for a in xs) / 3) ** 0.5
    sy = (sum((b - my) ** 2 for b in ys) / 3) ** 0.5
    assert r.n_groups == 3 and r.pearson == pytest.approx(cov / (sx * sy))


SCORES = '''"gender","race","parent","lunch","prep","math score","reading score","writing score"
"female","group B","x","standard","none","72","72","74"
"female","group C","x","standard","completed","69","90","88"
"male","group B","x","free","none","90","95","93"
"male","group A","x","free","none","47","57","44"
"female","group B","x","standard","none","abc","78","75"
'''


def test_score_jobs_drop_group_with_bad_score(spark, tmp_path):
    (tmp_path / "s.csv").write_text(SCORES)
    stats = {(r.dim, r.value): r for r in jobs.score_statistics(spark, str(tmp_path / "s.csv")).collect()}
    assert ("gender", "female") not in stats and ("race", "group B") not in stats   # bad score drops them
    assert stats[("gender", "male")].mean_math_score == pytest.approx(68.5)
    assert stats[("gender", "male")].std_math_score == pytest.approx(21.5)
    corr = {(r.dim, r.value): r.pearson for r in jobs.score_correlation(spark, str(tmp_path / "s.csv")).collect()}
    assert corr[("gender", "male")] == pytest.approx(1.0)
    assert ("gender", "female") not in corr and ("prep", "none") not in corr


def test_document_similarity_and_knn_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("the cat sat\non the mat\n\n")
    (tmp_path / "b.txt").write_text("the cat sat\non the mat\n\n")
    (tmp_path / "c.txt").write_text("dogs run far away\n")
    pairs = [tuple(r) for r in jobs.document_similarity(
        spark, [str(tmp_path / n) for n in ("a.txt", "b.txt", "c.txt")], threshold=0.01, k=100).collect()]
    # a and b are equal: 6 distinct tokens incl. the empty one from the blank line -> 2*6/200
    assert [p[:4] for p in pairs] == [("a.txt", "b.txt", 6, 0.06)]
    assert pairs[0][4].endswith("a.txt") and pairs[0][5].endswith("b.txt")

    (tmp_path / "wine.csv").write_text("alcohol,quality\n9.4,5\n9.8,5\n10.0,6\n11.2,6\n")
    recs = [f"({i}, [{i},{j},{abs(i - j) + 0.1 * j}])" for i in range(4) for j in range(4) if i != j]
    (tmp_path / "d.txt").write_text("\n".join(recs) + "\n")
    cm, acc = jobs.knn_evaluation(spark, str(tmp_path / "wine.csv"), str(tmp_path / "d.txt"), k=1)
    assert acc.first().accuracy == 0.75
    assert {(r.predicted, r.actual): r.n for r in cm.collect()} == {(5.0, 5.0): 2, (5.0, 6.0): 1, (6.0, 6.0): 1}


def test_row_index_is_consecutive_across_partitions(spark):
    from quarry.operators.neighbors import with_row_index

    df = spark.range(0, 1000, numPartitions=7).selectExpr("id * 3 as v")
    rows = sorted((r.id, r.v) for r in with_row_index(df).collect())
    assert [i for i, _ in rows] == list(range(1000))
    assert all(v == 3 * i for i, v in rows)   # scan order preserved
