"""Token ids, token files, packing and byte-level BPE against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import bpe, packing, spans, tokenfiles, tokens

RNG = random.Random(11)
ODD = ["", None, " ", "a" * 70, "İstanbul ΑΣ Σ", "é ́x", "a b c\x1cd\x85e", "<|endoftext|> hi", "'s don't it's 'RE", "x\u0000y",
       "🎉 👩‍👩‍👧", "가 ᆨ 한국", "1234 ½ Ⅻ ٣", "a|b | c", "don't 's 're'll ''s", "  a", "a  ", "\n\n a", "\n's", "J̌ǰ J̌."]
ODD += ["<|endoftext|>", "x<|startoftext|>Y.<|endoftext|>.z", "<|ENDOFTEXT|> <|EndOfText|>", "a <|endoftext|><|endoftext|>\nB",
        "<|startoftext|" + ">" * 3, "< |endoftext|>", "<|endoftext| >", "é<|startoftext|>́ TAIL'S"]
ODD += ["".join(RNG.choice("ab '́é \n\tΣß1½.,|srtvelmd🎉한 \x1f") for _ in range(RNG.randint(0, 40))) for _ in range(500)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))  # as it comes


def frame(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (3, "again"), (3, "again")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string") \
        .withColumns({"length": F.lit("clash"), "n_tokens": F.lit(1), "id": F.lit(2), "_class": F.lit(3)})


@pytest.mark.parametrize("target", [1 << 21, 16])
def test_word_ids_equal_whole_text_encoding(library, target):
    coder = tokens.word_ids()
    got = [[] for _ in ODD]
    for rows, ids, per in spans.whole_rows(coder.batches(pa.array(ODD), target)):
        at = np.concatenate([[0], np.cumsum(per)])
        for k, r in enumerate(rows.tolist()):
            got[r] = ids[at[k]:at[k + 1]].tolist()
    assert got == [e.ids for e in library.encode_batch([t or "" for t in ODD], add_special_tokens=False)]


def test_special_strings_can_be_ordinary_text():
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.encode_special_tokens = True
    coder = tokens.WordIds(tokens.vocabulary(), special_text=True)
    got = np.concatenate([ids for _, ids, _ in coder.batches(pa.array(["<|endoftext|> x"]))])
    assert got.tolist() == library.encode("<|endoftext|> x", add_special_tokens=False).ids


def test_pool_starts_anew_when_full(library):
    coder = tokens.WordIds(tokens.vocabulary())
    coder.pool.limit = 5
    for rows, ids, _ in coder.batches(pa.array(["one two three four", "five six seven one", "two eight"]), 8):
        pass
    out = np.concatenate([ids for _, ids, _ in coder.batches(pa.array(["one two nine"]), 4)])
    assert out.tolist() == library.encode("one two nine", add_special_tokens=False).ids


def test_token_files_read_back_in_id_order(spark, work, library):
    rows, df = frame(spark, ODD)
    manifest, folder = tokenfiles.save_tokens(df, work)
    got = tokenfiles.read_tokens(manifest, folder).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    at, want = 0, []
    for i, t in order:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    empty, folder = tokenfiles.save_tokens(df.limit(0), work)
    assert tokenfiles.read_tokens(empty, folder).count() == 0


def test_packing_covers_every_id_once(spark, work, library):
    rows, df = frame(spark, [*ODD, "lorem ipsum dolor " * 400, "word " * 64])
    got = packing.pack(df, work, capacity=64, unit=4).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)
    by_seq, by_doc = {}, {}
    for r in got:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert sorted(by_seq) == list(range(len(by_seq)))
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        if i != 3:
            parts = sorted(by_doc[i], key=lambda r: r["start"])
            assert [(r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in parts] == [
                (s, len(ids[s:s + 64]), zlib.crc32(np.array(ids[s:s + 64], "<u4").tobytes()), len(ids))
                for s in range(0, len(ids), 64)]
    total = sum(r["length"] for r in got)
    assert total > 0.9 * 64 * len(by_seq)
    assert packing.pack(df.limit(0), work).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_cutting_stock_covers_the_demand_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    demand = rng.integers(0, 400, 64)
    demand[-1] = 0
    plan = packing.cutting_stock(demand, 64)
    cut = np.zeros(65)
    for count, items in plan:
        assert sum(c * a for c, a in items.items()) <= 64
        for c, a in items.items():
            cut[c] += a * count
    assert (cut[1:] >= demand).all()
    least = -(-int((demand * np.arange(1, 65)).sum()) // 64)
    big = int(demand[32:].sum())  # no two of these share a sequence
    assert sum(n for n, _ in plan) <= 1.05 * max(least, big) + 3
    left, greedy = demand.copy(), 0  # first-fit decreasing over all pieces
    for pattern in packing.greedy_patterns(left, np.arange(1, 65), 64):
        times = int((left[pattern > 0] // pattern[pattern > 0]).min())
        left -= pattern * times
        greedy += times
    assert sum(n for n, _ in plan) <= greedy + 2
    assert packing.cutting_stock(np.zeros(8, np.int64), 8) == []


def test_knapsack_prices_the_best_pattern():
    dual = np.array([0.1, 0.0, 0.35, 0.45])
    value, pattern = packing.price(dual, 7)
    best = max((a * 0.1 + c * 0.35 + d * 0.45) for a in range(8) for c in range(3) for d in range(2) if a + 3 * c + 4 * d <= 7)
    assert abs(value - best) < 1e-12 and pattern @ np.arange(1, 5) <= 7 and abs(pattern @ dual - best) < 1e-12


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.vocabulary()


def test_perfect_hash_is_minimal_and_rejects_others(vocabulary):
    v = vocabulary
    one, two = spans.hashes(v.flat, np.cumsum(v.key_size) - v.key_size, v.key_size)
    assert sorted(v.hash.numbers(one, two).tolist()) == list(range(len(v.ranks)))
    other = np.frombuffer(b"qzxqzx vvvvvw", np.uint8)
    a, b = spans.hashes(other, np.array([0, 7]), np.array([6, 6]))
    assert v.whole(a, b).tolist() == [-1, -1]


@pytest.mark.parametrize("target", [1 << 21, 16])
def test_bpe_equals_the_library(vocabulary, target):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})
    coder = bpe.Coder(vocabulary)
    got = [[] for _ in ODD]
    for rows, ids, per in coder.batches(pa.array(ODD), target):
        at = np.concatenate([[0], np.cumsum(per)])
        for k, r in enumerate(rows.tolist()):
            got[r] += ids[at[k]:at[k + 1]].tolist()
    assert got == [own.encode_ordinary(t or "") for t in ODD]
    assert [vocabulary.decode(ids).decode() for ids in got] == [t or "" for t in ODD]
    assert bpe.merge(b"a" * 3000, vocabulary.ranks) == own.encode_ordinary("a" * 3000)


def test_bpe_digests(spark, vocabulary):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})
    rows, df = frame(spark, ODD)
    want = []
    for i, t in rows:
        ids = own.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, bpe.bpe_digests(df).collect()), key=repr) == sorted(want, key=repr)
    assert bpe.bpe_digests(df.limit(0)).count() == 0
