"""Relational operators on invented bakery-shaped rows (FIXTURES.md B)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry.operators import relational as rel

D = dt.date


@pytest.fixture(scope="module")
def bakery(spark):
    customers = spark.createDataFrame(
        [(1, "SMITH", "ANN"), (2, "SMITH", "ANN"), (3, "O'HARA", "BO"), (4, "LONELY", "NO")],
        "CId int, LastName string, FirstName string")
    goods = spark.createDataFrame(
        [("A-1", "Chocolate", "Cake", 4.99), ("A-2", "Chocolate", "Eclair", 5.00),
         ("A-3", "Chocolate", "Tart", 10.5), ("A-4", "Chocolate", "Pie", 9.5),
         ("C-1", "Gongolais", "Cookie", 1.25), ("T-1", "Apple", "Tart", 3.0)],
        "GId string, Flavor string, Food string, Price double")
    receipts = spark.createDataFrame(
        [(10, D(2007, 10, 1), 1), (11, D(2007, 10, 1), 2), (12, D(2007, 10, 15), 3),
         (13, D(2007, 10, 15), 3), (14, D(2007, 10, 16), 1), (15, D(2007, 10, 16), 1),
         (16, D(2007, 10, 31), 2), (17, D(2007, 11, 1), 3)],
        "Reciept int, Date date, CId int")
    items = spark.createDataFrame(
        [(10, 1, "C-1"), (10, 2, "C-1"), (11, 1, "A-1"), (12, 1, "T-1"), (13, 1, "A-3"),
         (16, 1, "C-1"), (17, 1, "C-1")] + [(14, i, "T-1") for i in range(11)]
        + [(15, i, "T-1") for i in range(10)],
        "Reciept int, Ordinal int, GId string")
    return customers, goods, receipts, items


def test_filter_sort_project_strict_and_numeric(bakery):
    _, goods, _, _ = bakery
    out = rel.filter_sort_project(goods, (F.col("Flavor") == "Chocolate") & (F.col("Price") < 5),
                                  ["Flavor", "Food", "Price"], [F.col("Price").desc()]).collect()
    assert [tuple(r) for r in out] == [("Chocolate", "Cake", 4.99)]  # 5.00 excluded: strict <
    out = rel.filter_sort_project(goods, (F.col("Flavor") == "Chocolate") & (F.col("Price") < 20),
                                  ["Food", "Price"], [F.col("Price").desc()]).collect()
    assert [r.Price for r in out] == [10.5, 9.5, 5.0, 4.99]  # numeric, not text order


def test_semi_join_one_row_per_customer(bakery):
    customers, _, receipts, _ = bakery
    out = rel.semi_join_on_day(customers, receipts, "CId", "CId", "Date", "2007-10-16",
                               ["CId", "LastName"], ["LastName"]).collect()
    assert [tuple(r) for r in out] == [(1, "SMITH")]  # two receipts that day, one row


def test_repeat_days_merge_namesakes_inclusive_bounds(bakery):
    customers, _, receipts, _ = bakery
    out = rel.repeat_days(receipts, customers, "CId", "CId", "Date", ["LastName", "FirstName"],
                          "2007-10-01", "2007-10-15").collect()
    # 1 Oct: customers 1 and 2 are both SMITH ANN -> 2 receipts for one name
    # 15 Oct: O'HARA twice (upper bound inclusive); 16 Oct is out of range
    assert [(r.day, r.day_text) for r in out] == [(D(2007, 10, 1), "01-Oct-2007"),
                                                  (D(2007, 10, 15), "15-Oct-2007")]


def test_union_distinct(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "d int")
    b = spark.createDataFrame([(2,), (3,)], "d int")
    assert sorted(r.d for r in rel.union_distinct(a, b).collect()) == [1, 2, 3]


def test_total_in_range_and_empty(bakery):
    _, goods, receipts, items = bakery
    oct_ = receipts.filter(rel.day_between("Date", "2007-10-01", "2007-10-31"))
    cookies = oct_.join(items, "Reciept").join(goods, "GId").filter(F.col("Food") == "Cookie")
    assert rel.total(cookies, "Price", "revenue").first().revenue == pytest.approx(3 * 1.25)
    none = cookies.filter(F.lit(False))
    assert rel.total(none, "Price", "revenue").first().revenue is None  # NULL, no error


def test_group_count_having_strict(bakery):
    _, goods, receipts, items = bakery
    tarts = receipts.join(items, "Reciept").join(goods, "GId").filter("Food = 'Tart'")
    out = rel.group_count_having(tarts, ["Date"], 10).collect()
    # 16 Oct: 21 tarts over two receipts (> 10); 15 Oct: one tart
    assert [(r.Date, r.n) for r in out] == [(D(2007, 10, 16), 21)]
    out = rel.group_count_having(tarts.filter("Reciept = 14"), ["Date"], 10).collect()
    assert [(r.Date, r.n) for r in out] == [(D(2007, 10, 16), 11)]
    out = rel.group_count_having(tarts.filter("Reciept = 15"), ["Date"], 10).collect()
    assert out == []  # exactly 10 is not > 10


def test_sum_by_and_top_n(bakery):
    customers, goods, receipts, items = bakery
    joined = receipts.join(items, "Reciept").join(goods, "GId").join(customers, "CId")
    spent = rel.sum_by(joined, ["LastName", "FirstName"], "Price", "TotalSpent")
    got = {(r.LastName, r.FirstName): r.TotalSpent for r in spent.collect()}
    assert got[("SMITH", "ANN")] == pytest.approx(2 * 1.25 + 4.99 + 21 * 3.0 + 1.25)
    assert ("LONELY", "NO") not in got  # no purchases -> absent (inner joins)
    counted = rel.group_count_having(items.join(goods, "GId"), ["Flavor", "Food"], count_name="NumSold")
    top = rel.top_n(counted, [F.col("NumSold").desc(), F.col("Flavor"), F.col("Food")], 1).collect()
    assert [tuple(r) for r in top] == [("Apple", "Tart", 22)]


def test_day_between_on_timestamps(spark):
    df = spark.createDataFrame([(dt.datetime(2007, 10, 31, 23, 59),), (dt.datetime(2007, 11, 1, 0, 0),)],
                               "t timestamp_ntz")
    assert df.filter(rel.day_between("t", "2007-10-01", "2007-10-31")).count() == 1


def test_star_join_chain(bakery):
    customers, goods, receipts, items = bakery
    joined = rel.star_join(receipts, [(items, "Reciept"), (goods, "GId"), (customers, "CId")])
    assert joined.count() == items.join(receipts, "Reciept").count()
    assert {"Reciept", "GId", "CId", "Price", "LastName"} <= set(joined.columns)
