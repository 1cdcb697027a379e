"""Importance resampling, ranked search and best-fit packing against brute force."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import bestfit, resample, search
from quarry.llm.queries import QUERIES
from quarry.llm.terms import word_runs
from tests.conftest import SF001

ASCII_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().translate(ASCII_LOWER))


def grams(text):
    w = words(text)
    return w + [a + b" " + b for a, b in zip(w, w[1:])]


TEXTS = ["The cat sat on the mat", None, "", "ÀÉ ß é È x1 x1 x1", "-- .. \n\t", "the the the the",
         "a" * 70 + " " + "b" * 300 + " the " + "é" * 40, "one\x00two_three`four{five", "word" * 5 + " word " * 3,
         "cat sat " * 30]


# ------------------------------------------------------------ words and their sums

def test_words_of_long_texts_stay_whole_over_slices():
    text = "Alpha BÉta " * 700
    got = []
    for rows, piece, start, length, part in word_runs(pa.array(["x y", text, None, "z"]), target=1000):
        got += [(int(rows[p]), piece[s:s + n].tobytes()) for s, n, p in zip(start, length, part)]
    assert got == [(0, b"x"), (0, b"y")] + [(1, w) for w in words(text)] + [(3, b"z")]


@pytest.mark.parametrize("kind", ["empty", "some", "all"])
def test_features_do_not_depend_on_the_head(kind):
    texts = TEXTS + ["ab cd é " * 300_000 + "Z" * 100]  # several slices
    every = sorted({w for t in texts for w in words(t) if len(w) <= 16})
    pairs = sorted({(a, b) for t in texts for a, b in zip(words(t), words(t)[1:]) if max(len(a), len(b)) <= 16})
    head = {"empty": resample.Head.build([], [], 997),
            "some": resample.Head.build([b"the", b"cat", b"ab", b"x1"], [(b"the", b"the"), (b"ab", b"cd")], 997, bits=3),
            "all": resample.Head.build(every, pairs, 997)}[kind]
    count, found = collections.Counter(), collections.defaultdict(collections.Counter)
    for rows, n, place, bucket in resample.features(pa.array(texts), head, 997):
        for i, x in zip(rows.tolist(), n.tolist()):
            count[i] += x
        for i, b in zip(rows[place].tolist(), bucket.tolist()):
            found[i][b] += 1
    for i, t in enumerate(texts):
        assert count[i] == len(words(t))
        assert found[i] == collections.Counter(zlib.crc32(f) % 997 for f in grams(t))


def drawn(docs, target, percent, min_words, buckets, seed="7"):
    s, t = [0] * buckets, [0] * buckets
    for text in target:
        for f in grams(text):
            t[zlib.crc32(f) % buckets] += 1
    for _, text in docs:
        for f in grams(text):
            s[zlib.crc32(f) % buckets] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, text in docs:
        g = grams(text)
        weight = sum(gain[zlib.crc32(f) % buckets] for f in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))),
                     len(words(text)) >= min_words))
    top = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    top = top[:percent * len(top) // 100]
    ranks = collections.Counter(r[:4] for r in top)
    out = [(*r[:4], i + 1) for i, r in enumerate(top)]
    for r in rows:
        if ranks[r[:4]] and r[4]:
            ranks[r[:4]] -= 1
        else:
            out.append((*r[:4], None))
    return sorted(out, key=repr)


def test_resampling_equals_brute_force_with_nulls_ties_and_repeated_rows(spark, work):
    docs = [(i, TEXTS[i % len(TEXTS)]) for i in range(80)] + [(3, "cat sat mat"), (3, "cat sat mat"), (None, "cat the"),
                                                              (None, "cat the"), (-5, "the mat é")]
    target = [("the cat", 1), (None, 2), ("mat mat", 3)]
    frame = spark.createDataFrame([(i, t, 1, i) for i, t in docs], "doc_id long, text string, rank int, words long")
    got = resample.importance_resample(frame, spark.createDataFrame(target, "text string, n int"), work, percent=40,
                                       min_words=2, buckets=50)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == drawn(docs, [t for t, _ in target], 40, 2, 50)


def test_many_rows_of_one_id_are_ranked_over_partitions(spark, work):
    docs = [(9, "the cat sat")] * 300 + [(i, "the cat sat on") for i in range(10)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = resample.importance_resample(frame, spark.createDataFrame([("the cat",)], "text string"), work, percent=50,
                                       min_words=1, buckets=11)
    assert sorted(map(tuple, got.collect()), key=repr) == drawn(docs, ["the cat"], 50, 1, 11)


def test_resampling_of_nothing_and_towards_nothing(spark, work):
    docs, none = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([], "text string")
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert resample.importance_resample(empty, docs, work).count() == 0
    got = resample.importance_resample(docs, none, work, percent=100, min_words=1, buckets=7)
    assert list(map(tuple, got.collect())) == drawn([(1, "a b c")], [], 100, 1, 7)


# ------------------------------------------------------------ ranked search

def ranking(docs, items, k):
    terms = [(i, collections.Counter(words(t)), len(words(t))) for i, t in docs]
    n_docs, n_words = sum(n > 0 for _, _, n in terms), sum(n for _, _, n in terms)
    df = collections.Counter(w for _, c, _ in terms for w in c)
    texts = collections.defaultdict(set)
    for item, text in items:
        if item is not None and text is not None:
            texts[item].add(text)
    out = []
    for item, several in texts.items():
        query = collections.Counter(w for t in several for w in words(t))
        scores = []
        for i, c, n in terms:
            if not n:
                continue
            m = 100 - 25 + (25 * n * n_docs) // n_words
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) *
                    ((1_000_000_000 * c[w]) // (1000 * c[w] + 12 * m)) for w, q in query.items() if c[w])
            if s > 0:
                scores.append((s, i))
        scores.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, r + 1, i, s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out, key=repr)


ITEMS = [(1, "the cat"), (1, "the cat"), (1, "é x1 x1"), (2, "nowhere found"), (3, None), (None, "cat"), (4, ""),
         (5, "sat the the on mat cat " * 3), (6, "b" * 300 + " five")]


@pytest.mark.parametrize("options", [
    {}, {"block_docs": 3, "bundle_items": 1}, {"block_docs": 7, "bundle_items": 2, "shares": (0.02, 0.05, 0.2, 0.5)},
    {"batch_terms": 4, "block_docs": 16}], ids=["default", "small", "owners", "passes"])
def test_search_equals_brute_force(spark, work, options):
    rng = np.random.default_rng(5)
    pool = [w.decode() for t in TEXTS for w in words(t) if len(w) < 20] + [f"w{i}" for i in range(40)]
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(i + 20, TEXTS[0]) for i in range(30)]  # ties
    docs += [(100 + i, " ".join(rng.choice(pool, rng.integers(1, 30)))) for i in range(60)]
    docs += [(None, "the cat é"), (7, "the cat é"), (7, "the cat é"), (8, "cat " * 5000)]
    frame = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, item_id int, score string")
    asked = spark.createDataFrame([(i, t, 3) for i, t in ITEMS], "item_id long, text string, doc_id int")
    got = search.ranked_search(frame, asked, work, k=5, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == ranking(docs, ITEMS, 5)


def test_search_of_empty_tables(spark, work):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search.ranked_search(docs.limit(0), items, work).count() == 0
    assert search.ranked_search(docs, items.limit(0), work).count() == 0


def test_lengths_beyond_64_bits():
    n = np.array([0, 5, 7_000_000_000], np.int64)
    assert search.lengths(n, 10 ** 12, 10 ** 15).tolist() == [75 + 25 * x * 10 ** 12 // 10 ** 15 for x in n.tolist()]


# ------------------------------------------------------------ best fit

def test_sweep_gives_every_document_the_first_slot_that_is_left(spark, work):
    rng = np.random.default_rng(3)
    docs = rng.integers(1, 40, 300).tolist() + [17] * 200
    slots = rng.integers(1, 45, 320).tolist() + [17] * 50
    frame = spark.createDataFrame([(i, 0, n, 0, i) for i, n in enumerate(docs)],
                                  "doc_id long, start long, length int, ids_crc32 long, pid long")
    places = spark.createDataFrame([(i, n) for i, n in enumerate(slots)], "sequence_id long, size int")
    placed, free, n_slots, fits = bestfit.swept(frame, places, work)
    ordered = sorted(slots)
    want, at = [], 0
    for rank, n in enumerate(sorted(docs)):  # one after the other
        while at < len(ordered) and ordered[at] < n:
            at += 1
        want.append((rank, n, at if at < len(ordered) else None))
        at += 1
    got = sorted((r["rank"], r["length"], r["slot"] if r["slot"] < n_slots else None) for r in placed.collect())
    assert n_slots == len(slots) and got == want and fits == sum(s is not None for _, _, s in want)
    assert [slots[r["sequence_id"]] for r in sorted(free.collect(), key=lambda r: r["slot"])] == ordered


def check_packing(rows, lengths, capacity):
    """rows: (doc_id, piece, start, length, ids_crc32, sequence_id, offset); lengths by doc_id."""
    bins, seen = collections.defaultdict(list), collections.defaultdict(list)
    for doc_id, piece, start, length, _, seq, offset in rows:
        bins[seq].append((offset, length))
        seen[doc_id].append((piece, start, length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    for doc_id, n in lengths.items():
        want = [(i, i * capacity, min(capacity, n - i * capacity)) for i in range(-(-n // capacity))]
        assert sorted(seen[doc_id]) == want
    assert len(seen) == len(lengths)
    return len(bins)


@pytest.mark.parametrize("spare", [1, 4])
def test_best_fit_packs_whole_documents_tightly(spark, work, spare):
    rng = np.random.default_rng(11)
    sizes = rng.geometric(0.06, 900).clip(1, 300).tolist() + [30] * 500 + [0, 64, 63, 128, 129]
    docs = [(i, " ".join(["cat"] * n) if n else None) for i, n in enumerate(sizes)]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, gap int, size int")
    got = bestfit.best_fit(frame, work, capacity=64, end_id=1, ratio=1.3, spare=spare)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    used = check_packing(list(map(tuple, got.collect())), {i: n + 1 for i, n in enumerate(sizes)}, 64)
    assert used <= 1.02 * -(-sum(n + 1 for n in sizes) // 64) + 2


def test_best_fit_repeated_and_null_rows_and_no_rows(spark, work):
    frame = spark.createDataFrame([(1, "cat cat"), (1, "cat cat"), (None, None), (None, "cat")], "doc_id long, text string")
    rows = bestfit.best_fit(frame, work, capacity=8).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 1), (0, 2), (1, 3), (1, 3)]
    assert len({r["sequence_id"] for r in rows}) == 2
    assert bestfit.best_fit(frame.limit(0), work, capacity=8).count() == 0
    none = bestfit.best_fit(frame.filter("text is null"), work, capacity=8, end_id=None)
    assert none.count() == 0 and none.columns[0] == "doc_id"


def test_query_packs_all_documents(spark):
    from tokenizers import Tokenizer

    from quarry.llm.tokens import vocabulary

    library = Tokenizer.from_file(vocabulary())
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    ids = {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in docs}
    rows = list(map(tuple, QUERIES["op13_best_fit"](spark, SF001).collect()))
    used = check_packing(rows, {i: len(x) for i, x in ids.items()}, 4096)
    for doc_id, _, start, length, crc, _, _ in rows:
        assert crc == zlib.crc32(np.array(ids[doc_id][start:start + length], "<u4").tobytes())
    assert used <= 1.02 * -(-sum(map(len, ids.values())) // 4096) + 1
