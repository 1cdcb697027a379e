"""Record scan, ordered sink, JSON members, mergeable moments, many keywords, rejects."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry import sources
from quarry.operators import keywords as kw
from quarry.operators import moments, rejects
from quarry.operators import stats as st
from quarry.operators.common import Scratch
from quarry.plans import jobs


@pytest.fixture()
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


RECORDS = [
    {"id": "1", "county": "O'BRIEN County", "population": "1,234 "},
    {"id": "2", "county": "a } b { c", "population": "{\"x\": \"}\"}"},
    {"id": "3", "county": "quote \" brace } backslash \\", "population": "\\\\"},
    {"id": "4", "nested": {"deep": {"deeper": "}{"}, "list": [{"a": 1}, {"b": "\"}\""}]}, "county": "ends with \\"},
    {"county": "no id"}, {"id": "5", "county": "ü €  ", "population": ""}, {"id": "6", "long": "x{" * 300, "county": "l"},
]
SCHEMA = "id string, county string, population string"


@pytest.mark.parametrize("layout", ["array", "objects", "lines", "one"])
def test_scanned_records_equal_multi_line_json(spark, tmp_path, small_splits, layout):
    rng = random.Random(4)
    records = [rng.choice(RECORDS) for _ in range(1 if layout == "one" else 150)]
    text = {"array": json.dumps(records, indent=2), "objects": "\n".join(json.dumps(r, indent=1) for r in records) + "\n ",
            "lines": "".join(json.dumps(r) + "\n" for r in records), "one": json.dumps(records[0])}[layout]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(text)
    (tmp_path / "in" / "b.json").write_text(text)
    (tmp_path / "in" / "empty.json").write_text("")
    got = sources.scan_json_records(spark, str(tmp_path / "in"), SCHEMA, member="id")
    want = [tuple(r.get(c) for c in ("id", "county", "population")) for r in records if "id" in r] * 2
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    if layout == "array":
        same = sources.read_json_records(spark, str(tmp_path / "in" / "a.json"), SCHEMA, member="id")
        assert sorted([*map(tuple, same.collect())] * 2, key=repr) == sorted(map(tuple, got.collect()), key=repr)
        assert spark.read.option("lineSep", "}").text(str(tmp_path / "in" / "a.json")).rdd.getNumPartitions() > 20  # many tasks


def test_objects_keep_their_text_and_cut_off_ones_go(spark, tmp_path, small_splits):
    (tmp_path / "x.json").write_text('[{"id": 1, "t": "a}b"},\n {"id": {"v": 2}} , {"id": 3')
    got = [r["value"] for r in sources.json_objects(spark, str(tmp_path / "x.json")).collect()]
    assert sorted(got) == ['{"id": 1, "t": "a}b"}', '{"id": {"v": 2}}']
    (tmp_path / "y.json").write_text('{"id": 1} {"id": oops} {"id": 4}')
    rows = sources.scan_json_records(spark, str(tmp_path / "y.json"), "id int", corrupt_column="bad").collect()
    assert sorted((r["id"] or 0, r["bad"]) for r in rows) == [(0, '{"id": oops}'), (1, None), (4, None)]


def test_json_members(spark):
    rows = [(1, '{"a": 1, "b": {"c": [1, 2]}, "d": null, "e f": "x"}'), (2, "{}"), (3, None), (4, "broken"), (5, '{"a": true}')]
    df = spark.createDataFrame(rows, "id int, j string")
    got = sorted(map(tuple, sources.json_members(df, "j", "id").collect()))
    assert [(i, k, v) for i, k, v in got if i != 4] == [
        (1, "a", "1"), (1, "b", '{"c":[1,2]}'), (1, "d", None), (1, "e f", "x"), (5, "a", "true")]
    assert not [r for r in got if r[0] == 4 and r[2] is not None]


def test_ordered_files_are_sorted_as_a_whole_and_a_hot_value_is_split(spark, tmp_path):
    rows = [("hot" if i % 3 else f"k{i % 50:02d}", i * 7919 % 5000) for i in range(5000)]
    df = spark.createDataFrame(rows, "a string, b int").repartition(7)
    path = str(tmp_path / "out")
    sources.write_ordered(df, path, ["a", "b"], files=50, format="tsv")
    back = sources.read_ordered(spark, path, "a string, b int", "tsv")
    got = sorted(map(tuple, back.select("position", "a", "b").collect()))
    assert [(a, b) for _, a, b in got] == sorted(rows) and [p for p, _, _ in got] == list(range(5000))
    files = spark.read.option("sep", "\t").schema("a string, b int").csv(path).groupBy(F.col("_metadata.file_name").alias("f")) \
        .agg(F.count("*").alias("n"), F.sum((F.col("a") == "hot").cast("int")).alias("hot")).collect()
    assert 40 <= len(files) <= 50 and sum(r["hot"] > 0 for r in files) > 20 and max(r["n"] for r in files) < 500
    descending = str(tmp_path / "down")
    sources.write_ordered(df, descending, [F.col("b").desc(), "a"], files=5)
    down = sources.read_ordered(spark, descending, "a string, b int").orderBy("position").collect()
    assert [r["b"] for r in down] == sorted((b for _, b in rows), reverse=True)


def test_merged_moments_equal_one_pass(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i % 3), int(i % 7), float(1e3 + x), float(y), float(2 * x + y)) for i, (x, y) in
            enumerate(zip(rng.normal(size=3000), rng.normal(scale=1e-3, size=3000)))]
    rows += [(9, 0, 5.0, 1.0, 1.0), (None, 1, 1.0, 2.0, 3.0), (None, 2, 2.0, 2.0, 5.0), (0, 1, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g int, part int, x double, y double, z double")
    ms = ["x", "y", "z"]
    whole = {r["g"]: r for r in moments.moment_results(moments.moment_state(df, ["g"], ms), ["g"], ms).collect()}
    parts = [moments.moment_state(df.filter(F.col("part") == p), ["g"], ms) for p in range(7)]
    first = moments.merge_states(parts[:4], ["g"], ms)  # what is there already
    for merged in (moments.merge_states([first, *parts[4:]], ["g"], ms),
                   moments.merge_states(moments.moment_state(df, ["g", "part"], ms), ["g"], ms)):
        got = {r["g"]: r for r in moments.moment_results(merged, ["g"], ms).collect()}
        assert got.keys() == whole.keys()
        for g, r in whole.items():
            for c in merged.columns[1:2] + [c for c in r.asDict() if c != "g"]:
                assert got[g][c] == r[c] or got[g][c] == pytest.approx(r[c], rel=1e-12, abs=1e-12), (g, c)
    data = np.array([r[2:] for r in rows if r[0] == 1])
    assert whole[1]["n"] == len(data) and whole[1]["corr_x_z"] == pytest.approx(np.corrcoef(data[:, 0], data[:, 2])[0, 1], rel=1e-9)
    assert whole[9]["std_x"] == 0.0 and whole[9]["corr_x_y"] is None
    with pytest.raises(ValueError):
        moments.merge_states(parts, [], ms)


def test_many_keywords_equal_one_by_one(spark):
    rng = random.Random(6)
    words = ["rum", "drum", "rumba", "vodka", "gin", "ginger", "a.b", "(x", "spiced rum"]
    pool = ["Rum", "rum", "DRUM", "drum", "rumba", "rumbas", "vodka", "Vodka", "gin", "Ginger", "a.b", "axb", "(x", "spiced", "tea"]
    rows = [(f"c{rng.randint(0, 8)}", " ".join(rng.choice(pool) for _ in range(rng.randint(0, 3))),
             rng.choice([None, "", "gin tonic", "spiced rum"])) for _ in range(400)]
    df = spark.createDataFrame(rows, "county string, t1 string, t2 string")
    counts = kw.keyword_group_counts(df, "county", ["t1", "t2"], words)
    got = {(r["county"], r["keyword"]): r["n"] for r in counts.collect()}
    one = st.keyword_counts(df, "county", ["t1", "t2"], {f"k{i}": w for i, w in enumerate(words)})
    want = {(r["county"], w): r[f"n_k{i}"] for r in one.collect() for i, w in enumerate(words) if r[f"n_k{i}"]}
    assert got == want
    pairs = {(r["x"], r["y"]): (r["n_groups"], r["pearson"]) for r in kw.keyword_correlations(counts, "county", words).collect()}
    assert len(pairs) == len(words) * (len(words) - 1) // 2
    for x, y in [("rum", "drum"), ("rum", "vodka"), ("gin", "ginger"), ("a.b", "(x")]:
        r = st.keyword_correlation(df, "county", ["t1", "t2"], x, y).first()
        assert pairs[x, y][0] == r["n_groups"]
        assert pairs[x, y][1] == r["pearson"] or pairs[x, y][1] == pytest.approx(r["pearson"], rel=1e-9)
    named = kw.keyword_group_counts(df, "county", ["t1"], {"spirits": ["rum", "gin"], "none": ["zzz"]})
    assert {r["keyword"] for r in named.collect()} == {"spirits"}
    assert kw.keyword_group_counts(df, "county", ["t1"], []).count() == 0


def test_plan_does_not_grow_with_the_keywords(spark):
    df = spark.createDataFrame([("c", "t")], "g string, t string")
    sizes = []
    for n in (2, 200):
        counts = kw.keyword_group_counts(df, "g", ["t"], [f"word{i}" for i in range(n)])
        sizes.append(counts._jdf.queryExecution().optimizedPlan().toString().count("RegExpExtractAll")
                     + counts._jdf.queryExecution().optimizedPlan().toString().count("\n"))
    assert sizes[0] == sizes[1]
    assert kw.trie_pattern(["ab", "a", "abc", "x.y"]) == r"(?:a(?:b(?:c)?)?|x\.y)"


def test_rejects_and_counts_without_a_second_pass(spark):
    rows = [(1, "a", 2), (2, None, 3), (3, "b", None), (4, None, None), (5, "c", 6)]
    df = spark.createDataFrame(rows, "id int, s string, n int")
    good, seen = rejects.counted(df, ["s", "n"])
    assert sorted(r["id"] for r in good.collect()) == [1, 5]
    want = {"rows": 5, "rejected": 3, "no_s": 2, "no_n": 2}
    assert seen.get == want
    scratch = Scratch(spark)
    ok, bad, counts = rejects.split_once(df, ["s", "n"], scratch)
    assert counts == want and ok.columns == bad.columns == df.columns
    assert sorted(r["id"] for r in ok.collect()) == [1, 5] and sorted(r["id"] for r in bad.collect()) == [2, 3, 4]
    plan = ok._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Scan ExistingRDD" not in plan and "PartitionFilters: [isnotnull(_good" in plan
    _, none, counts = rejects.split_once(df.limit(0), ["s"], scratch)
    assert none.count() == 0 and counts == {"rows": 0, "rejected": 0, "no_s": 0}
    scratch.release()


SCORES = '''"gender","race","parent","lunch","prep","math score","reading score","writing score"
"female","group B","x","standard","none","72","72","74"
"male","group B","x","free","none","90","95","93"
"male","group A","x","free","none","47","57","44"
"female","group C","x","standard","completed","{}","{}","75"
'''


def test_score_jobs_say_what_a_bad_score_does(spark, tmp_path):
    math, reading = tmp_path / "m.csv", tmp_path / "r.csv"
    math.write_text(SCORES.format("abc", "78"))
    reading.write_text(SCORES.format("70", "n/a"))
    by = lambda df: {(r["dim"], r["value"]): r for r in df.collect()}
    # the first score drops its row's groups, another fails the job; the correlation does not read the second
    assert ("gender", "female") not in by(jobs.score_statistics(spark, str(math)))
    with pytest.raises(Exception, match="reading"):
        jobs.score_statistics(spark, str(reading)).collect()
    assert by(jobs.score_correlation(spark, str(reading)))[("gender", "female")]["n"] == 2
    assert ("gender", "female") not in by(jobs.score_correlation(spark, str(math)))
    for job in (jobs.score_statistics, jobs.score_correlation):
        with pytest.raises(Exception, match="math"):
            job(spark, str(math), bad="raise").collect()
        scratch = Scratch(spark)
        out, lines, counts = job(spark, str(math), bad="reject", scratch=scratch)
        assert by(out)[("gender", "female")]["n"] == 1 and ("race", "group C") not in by(out)
        assert [r["line"] for r in lines.collect()] == ["female,group C,x,standard,completed,abc,78,75"]
        assert (counts["rows"], counts["rejected"], counts["no_math_score"]) == (4, 1, 1)
        scratch.release()
        with pytest.raises(ValueError):
            job(spark, str(math), bad="whatever")
    skipped = by(jobs.score_statistics(spark, str(math), bad="skip"))[("gender", "female")]
    assert skipped["mean_math_score"] == 72.0 and skipped["mean_reading_score"] == 75.0


@pytest.mark.parametrize("chunk", [1, 2, 3])
def test_json_objects_across_chunks_of_a_split(spark, tmp_path, monkeypatch, chunk):
    """One file, one split, cut into chunks that are many tasks' work: objects
    that cross any number of chunks come out whole."""
    from quarry.sources import records

    monkeypatch.setattr(records, "CHUNK", chunk)
    want = [{"id": i, "t": "} {\" \\" * (i % 4), "o": {"a": [{"b": {"c": "}" * (i % 3)}}] * (i % 3)}} for i in range(40)]
    (tmp_path / "a.json").write_text("[" + ",\n".join(json.dumps(x, indent=i % 2) for i, x in enumerate(want)) + "]")
    out = records.json_objects(spark, str(tmp_path / "a.json"))
    assert sorted((json.loads(r["value"]) for r in out.collect()), key=lambda x: x["id"]) == want
