"""Personal data and toxicity: patterns, disguises, grammar, odd inputs."""

import hashlib
import random
import time
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import pii, toxicity

E = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
I = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # noqa: E741
C = re.compile(r"[0-9]([\x20-]?[0-9])+")
P = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in E.finditer(t)]
    out += [("ip", *m.span()) for m in I.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in C.finditer(t) if 13 <= len(digits(m)) <= 19 and pii._luhn(digits(m))]
    return out + [("phone", *m.span()) for m in P.finditer(t) if 9 <= len(digits(m)) <= 15]


def test_identifiers_equal_the_patterns():
    rng = random.Random(2)
    for _ in range(20000):
        t = "".join(rng.choice("ab@@..1234+-  ()%_x5678900") for _ in range(rng.randint(0, 60)))
        assert pii.identifiers(t) == brute(t)


@pytest.mark.parametrize("unit", ["a", "1", "1.", "a@", "+1 ", "4 ", "1.1.1.1 dot ", "a@b.co x [at] y [dot] z ", "one two "])
def test_long_texts_are_read_in_linear_time(unit):
    def seconds(n):
        text, best = unit * (n // len(unit)), 1e9
        for _ in range(3):
            began = time.perf_counter()
            pii.find(text)
            best = min(best, time.perf_counter() - began)
        return best

    assert seconds(120_000) <= 4 * 2.2 * seconds(30_000) + 0.02  # quadratic time would be sixteen times as much


@pytest.mark.parametrize("text,kind,source", [
    ("write john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
    ("reach john at example dot com please", "email", "john at example dot com"),
    ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("so a​b@c​.com is", "email", "a​b@c​.com"),
    ("user@example dot org.", "email", "user@example dot org"),
    ("john_at_example_dot_com", "email", "john_at_example_dot_com"),
    ("jean (arobase) exemple (point) fr", "email", "jean (arobase) exemple (point) fr"),
    ("juan (arroba) ejemplo.es", "email", "juan (arroba) ejemplo.es"),
    ("hans [bei] beispiel [punkt] de", "email", "hans [bei] beispiel [punkt] de"),
    ("ip 192 dot 168 dot 1 dot 10 ok", "ip", "192 dot 168 dot 1 dot 10"),
    ("one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
    ("card four" + " one" * 15 + " end", "card", "four" + " one" * 15),
    ("Karte vier" + " eins" * 15, "card", "vier" + " eins" * 15),
    ("call plus one four one five five five five one two three four", "phone",
     "plus one four one five five five five one two three four"),
    ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("+４９ (30) 1234567", "phone", "+４９ (30) 1234567"),
])
def test_disguises_map_back_to_the_source(text, kind, source):
    added = [s for s in pii.find(text) if s.added]
    assert [(s.kind, text[s.start:s.end]) for s in added] == [(kind, source)]


@pytest.mark.parametrize("text", ["look at example.com", "meet me at noon. the dot on the i", "one, two, three", "un deux trois",
                                  "Москва и Αθήνα 2024", "a at b dot", "", "we are at one dot"])
def test_clean_texts_have_no_spans(text):
    assert pii.find(text) == []


def test_base_spans_stay_beside_added_ones():
    t = "é a@b.co, 4111 1111 1111 1111 and c [at] d [dot] org"
    found = pii.find(t)
    assert [(s.kind, s.start, s.end) for s in found if not s.added] == brute(t)
    assert pii.redact(t, found) == "é <EMAIL>, <CARD> and <EMAIL>"


def test_pii_rows(spark):
    rows = [(1, "a@b.co x [at] y [dot] com"), (2, None), (3, ""), (None, "1.2.3.4"), (1, "a@b.co"), (1, "a@b.co")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("clash"))
    got = sorted(map(tuple, pii.pii_spans(df).collect()), key=repr)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == sorted([
        (1, 1, 0, 0, 0, sha("email:0:6"), "email:0:6,email:7:25", 1), (2, 0, 0, 0, 0, sha(""), "", 0),
        (3, 0, 0, 0, 0, sha(""), "", 0), (None, 0, 1, 0, 0, sha("ip:0:7"), "ip:0:7", 0),
        (1, 1, 0, 0, 0, sha("email:0:6"), "email:0:6", 0), (1, 1, 0, 0, 0, sha("email:0:6"), "email:0:6", 0)], key=repr)
    clean = pii.redact_pii(df)
    assert clean.columns == df.columns
    assert {r["text"] for r in clean.collect()} == {"<EMAIL> <EMAIL>", None, "", "<IP>", "<EMAIL>"}
    assert pii.pii_spans(df.limit(0)).count() == 0


def kinds(text, stems=()):
    return {toxicity.KINDS[i]: n for i, n in enumerate(toxicity.Scorer(list(stems)).counts(text)) if n}


def test_grammar_reads_clauses_not_words():
    assert kinds("You are an idiot. What a stupid day!") == {"aimed insult": 1, "bare insult": 1}
    assert kinds("You are not an idiot.") == {"denied": 1}
    assert kinds("He isn’t stupid") == {"denied": 1}
    assert kinds("She said that he is a moron.") == {"reported": 1}
    assert kinds("I will hurt you.") == {"aimed threat": 1}
    assert kinds("shoot the film") == {"bare threat": 1}
    assert kinds("not today. you moron") == {"aimed insult": 1}
    assert kinds("nobody called the idiotic trashcan") == {}
    assert kinds("Blarx und blarxo. Blarx", ["blarx"]) == {"learned": 3}
    assert kinds("") == kinds(None) == {}


def test_fit_keeps_priors_without_examples():
    assert (toxicity.fit(np.zeros((0, 8)), np.zeros(0)) == toxicity.PRIOR).all()
    x = np.zeros((40, 8))
    x[:20, 0] = 2
    w = toxicity.fit(x, np.r_[np.ones(20), np.zeros(20)])
    assert toxicity.score(x[:1], w)[0] > 0.9 > 0.3 > toxicity.score(x[-1:], w)[0]
    assert w[2] == toxicity.PRIOR[2]


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 6)))
    rows, labels = [], []
    for i in range(300):
        words = [word() for _ in range(40)]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(["you idiot", "such scum"]) if i % 2 else "zorkul" + word()[:2]
        rows.append((i, ". ".join(" ".join(words[j:j + 5]) for j in range(0, 40, 5))))
        if i % 5:
            labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_learns_stems_and_scores_every_row(spark, work):
    rows, labels = corpus()
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (None, "you idiot"), (0, rows[0][1])], "doc_id long, text string") \
        .withColumns({"score": F.lit("clash"), "y": F.lit(1), "_id": F.lit(2)})
    marks = spark.createDataFrame([*labels, (None, 1), (1, None), (2, 0), (2, 1), (7, 5)], "doc_id long, toxic int")
    stems, _ = toxicity.learn(docs, marks, work, rows=500)
    assert any("zorkul".startswith(s) or s.startswith("zorkul") for s in stems) and len(stems) < 4
    got = toxicity.toxicity(docs, marks, work, rows=500).collect()
    assert len(got) == 304 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    truth = {i: int(i % 3 == 0) for i, _ in rows}
    right = [r["predicted"] == truth[r["doc_id"]] for r in got if r["doc_id"] in truth]
    assert sum(right) >= 0.97 * len(right)
    kept = toxicity.reject_toxic(docs, marks, work, rows=500)
    assert kept.columns == docs.columns and {900, 901} <= {r["doc_id"] for r in kept.collect()}
    none = toxicity.toxicity(docs.limit(0), marks.limit(0), work)
    assert none.count() == 0
    plain = toxicity.toxicity(docs, marks.limit(0), work).filter("doc_id is null").first()
    assert plain["predicted"] == 1


def test_copies_of_one_text_teach_no_stems(spark, work):
    rows = [(i, "some qwertzuiop text stays here qwertzuiop again") for i in range(30)] + \
           [(100 + i, f"plain text number{i} here") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i < 30)) for i, _ in rows], "doc_id long, toxic int")
    assert toxicity.learn(docs, marks, work)[0] == []
