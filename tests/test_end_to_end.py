"""The original jobs' input paths end to end, on invented files of the same
shape: header-less invoice lines read by position, a multi-line county JSON,
and a quoted scores CSV; expected values computed in plain Python."""

import json
import math
import statistics

import pytest

from quarry.functions.clean import normalize_key, strip_chars, to_int
from quarry.operators import stats as st
from quarry.sources import field, read_csv, read_fields, read_json_records

INVOICES = [
    # id, date, county, store, category text, item text, bottles, sale
    "S1,01/02/2015,Polk,12,American Rum,Spiced Rum,12,120.5",
    "S2,01/02/2015,Polk,12,Vodka 80 Proof,Rum Vodka Mix,6,30.25",
    "S3,01/03/2015,O'Brien,4,Imported Vodka,Smirnoff,2,22.0",
    "S4,01/03/2015,Story,9,Whiskey,Drum Kit Special,1,9.99",
    "S5,01/04/2015,Story,9,Vodka,DRUM,3,15.0",
    "S6,01/04/2015,Lee,3,Gin,Dry Gin,4,40.0",
]
COUNTIES = [
    {"id": "1", "county": "Polk County", "population": "474,045"},
    {"id": "2", "county": "OBrien County", "population": "14 020"},
    {"id": "3", "county": "Story County", "population": "97,117"},
    {"id": "4", "county": "Adams County", "population": "3,645"},
    {"county": "No Id County", "population": "1"},
]


@pytest.fixture()
def files(tmp_path):
    inv = tmp_path / "invoices.csv"
    inv.write_text("\n".join(INVOICES) + "\n")
    cty = tmp_path / "counties.json"
    cty.write_text(json.dumps(COUNTIES, indent=2))
    return str(inv), str(cty)


def test_sales_per_head_from_files(spark, files):
    inv_path, cty_path = files
    inv = read_fields(spark, inv_path).select(
        normalize_key(field("fields", 2), suffix=None).alias("county"),
        field("fields", -1).cast("double").alias("sales"))
    cty = read_json_records(spark, cty_path, "id string, county string, population string", member="id") \
        .select(normalize_key("county").alias("county"), to_int("population", strip=", ").alias("population"))
    out = {r.key: r for r in st.per_capita(inv, "county", "sales", cty, "county", "population").collect()}
    assert out["Polk"].total == pytest.approx(150.75)
    assert out["Polk"].per_head == pytest.approx(150.75 / 474045)
    assert out["OBrien"].total == 22.0 and out["OBrien"].population == 14020   # quote dropped, key joined
    assert out["Lee"].population is None and out["Lee"].per_head is None     # sales only
    assert out["Adams"].total == 0.0 and out["Adams"].per_head == 0.0        # population only
    assert "NoId" not in out


def test_keyword_correlation_from_files(spark, files):
    inv_path, _ = files
    rows = read_fields(spark, inv_path).select(
        field("fields", 2).alias("county"), field("fields", -4).alias("t1"), field("fields", -3).alias("t2"))
    counts = {r.county: (r.n_x, r.n_y) for r in
              st.keyword_counts(rows, "county", ["t1", "t2"], {"x": "rum", "y": "vodka"}).collect()}
    # Polk: 2 rum rows, 1 vodka row; O'Brien: vodka; Story: 'Drum' (substring) and a Vodka row
    assert counts == {"Polk": (2, 1), "O'Brien": (0, 1), "Story": (1, 1)}
    r = st.keyword_correlation(rows, "county", ["t1", "t2"], "rum", "vodka").first()
    assert r.n_groups == 3 and r.pearson is None  # vodka counts constant -> undefined, no error


SCORES = '''"gender","race/ethnicity","parental level of education","lunch","test preparation course","math score","reading score","writing score"
"female","group B","bachelor's degree","standard","none","72","72","74"
"female","group C","some college","standard","completed","69","90","88"
"male","group B","master's degree","free/reduced","none","90","95","93"
"male","group A","associate's degree","free/reduced","none","47","57","44"
"female","group B","some college","standard","none","76","78","75"
'''


def test_score_statistics_from_quoted_csv(spark, tmp_path):
    p = tmp_path / "scores.csv"
    p.write_text(SCORES)
    schema = ("gender string, race string, parent string, lunch string, prep string, "
              "math string, reading string, writing string")
    raw = read_csv(spark, str(p), schema=schema)               # header row skipped, quotes removed
    df = raw.select("gender", "race", "prep", *[to_int(strip_chars(c)).alias(c) for c in
                                                ("math", "reading", "writing")])
    out = {(r.dim, r.value): r for r in st.describe_by(df, ["gender", "race", "prep"],
                                                        ["math", "reading", "writing"]).collect()}
    female_math = [72, 69, 76]
    f = out[("gender", "female")]
    assert f.n == 3 and f.mean_math == pytest.approx(statistics.mean(female_math))
    assert f.std_math == pytest.approx(statistics.pstdev(female_math))
    assert ("gender", "gender") not in out                      # the header never became data
    corr = {(r.dim, r.value): r.pearson for r in st.corr_by(df, ["gender", "race", "prep"],
                                                             "math", "writing").collect()}
    gb_math, gb_write = [72, 90, 76], [74, 93, 75]
    mx, my = statistics.mean(gb_math), statistics.mean(gb_write)
    cov = sum((a - mx) * (b - my) for a, b in zip(gb_math, gb_write)) / 3
    want = cov / (statistics.pstdev(gb_math) * statistics.pstdev(gb_write))
    assert corr[("race", "group B")] == pytest.approx(want)
    assert corr[("race", "group A")] is None                    # one row: undefined
    assert math.isfinite(corr[("gender", "male")])
