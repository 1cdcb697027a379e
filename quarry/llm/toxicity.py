"""Toxicity by a weighted finite-state grammar over clauses.

Small transducers read the symbols of a clause together -- insult, threat,
target, negation, reported speech -- and their joint final state names the
kind of clause: a bare or aimed insult, a bare or aimed threat, one that is
denied, one that is only reported.  A text's score comes from how many clauses
of each kind it has, never from isolated words.

The insult transducer's lexicon has a fixed part and a learned part: word
stems that labelled toxic texts repeat in different contexts and clean ones
seldom hold.  Clauses with a learned stem are a kind of their own (what is
learned from counts says nothing of syntax), weighed by the number and
density of its matches.  The weights start from fixed values and are fitted to labelled rows.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WorkFolder
from quarry.llm.spans import tidy, worker_state

#: Fixed word lists of the grammar (whole words, lower case).
INSULT = ("idiot idiots moron morons loser losers pathetic worthless scum trash clown clowns disgusting stupid "
          "dumb fool fools jerk jerks garbage filth vermin imbecile cretin dimwit dumbass bastard bastards "
          "asshole assholes bitch bitches retard retarded scumbag dirtbag lowlife").split()
THREAT = "kill hurt destroy murder strangle stab shoot burn crush beat smash punch torture".split()
TARGET = ("you your yours yourself u ur he she him her they them their y'all du dich dir dein ihr euch "
          "tu toi ton ta vous votre tú ti usted ustedes vosotros").split()
NEGATION = ("not no never neither nor isn't aren't wasn't weren't don't doesn't didn't won't can't cannot "
            "nicht kein keine nie niemals pas jamais aucun nunca jamás").split()
REPORT = ("said says saying told called calls wrote claims claimed alleged quoted according reportedly "
          "sagte sagt schrieb dit disait dijo dice escribió").split()
INTENT = "will gonna shall i'll we'll going want werde werden vais voy".split()

#: Kinds of clauses, and the weights they have before any fit (log odds for
#: each unit of log(1 + clauses)); the first is the weight of no clause at all.
KINDS = ("bare insult", "aimed insult", "bare threat", "aimed threat", "denied", "reported", "learned")
#: ... the last is for learned matches per 10,000 characters.
PRIOR = np.array([-3.0, 5.8, 6.5, 0.5, 6.5, 0.3, 0.8, 1.0, 0.3])

_SYMBOL = {w: s for s, ws in (("T", THREAT), ("G", TARGET), ("N", NEGATION), ("R", REPORT), ("W", INTENT))
           for w in ws}
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_STOP = re.compile(r"[.!?;\n]")
#: Words that a negation reaches.
REACH = 4


class Grammar:
    """The five transducers run as one: states are made when first reached and
    every step is a table lookup from then on."""

    START = (0, 0, 0, 0, 0, 0, 0)  # target, negation's reach left, reported, intent, insult, threat, learned

    def __init__(self):
        self.steps: dict[tuple, tuple] = {}

    def step(self, state: tuple, symbol: str) -> tuple:
        key = (state, symbol)
        if key not in self.steps:
            self.steps[key] = self._step(state, symbol)
        return self.steps[key]

    @staticmethod
    def _step(state: tuple, symbol: str) -> tuple:
        target, reach, report, intent, insult, threat, learned = state
        reach = max(0, reach - 1)
        if symbol == "G":
            target = 1
        elif symbol == "N":
            reach = REACH
        elif symbol == "R":
            report = 1
        elif symbol == "W":
            intent = 1
        elif symbol == "L":
            learned = 1
        elif symbol in "IT":
            level = 1 if reach else 2 if report else 3  # denied, reported, meant
            if symbol == "I":
                insult = max(insult, level)
            else:
                threat = max(threat, level)
        return target, reach, report, intent, insult, threat, learned

    @staticmethod
    def kind(state: tuple) -> int | None:
        """Number of the clause's kind in ``KINDS``."""
        target, _, _, intent, insult, threat, learned = state
        if threat == 3 and target and intent:
            return 3
        if insult == 3:
            return 1 if target else 0
        if threat == 3:
            return 2
        if learned:
            return 6
        level = max(insult, threat)
        return None if not level else 4 if level == 1 else 5


class Scorer:
    """Clause counts of texts for one lexicon; one per worker process.  Stems
    match words that begin with them, whole words only themselves."""

    def __init__(self, stems: list[str]):
        import ahocorasick

        self.whole = set(INSULT) | set(THREAT)
        self.stems = tuple(stems)
        self.grammar = Grammar()
        self.match = ahocorasick.Automaton()
        for w in self.whole | set(stems):
            self.match.add_word(w, len(w))
        self.match.make_automaton()

    def _symbol(self, word: str) -> str:
        if word in self.whole:
            return "T" if word in _SYMBOL else "I"
        if self.stems and word.startswith(self.stems):
            return "L"
        return _SYMBOL.get(word, "-")

    def features(self, text: str | None) -> list[float]:
        """Clauses of each kind in a text (of the learned kind: matches in them),
        and learned matches per 10,000 characters."""
        out = self.counts(text)
        return [*out, out[-1] * 1e4 / max(100, len(text or ""))]

    def counts(self, text: str | None) -> list[int]:
        """Clauses of each kind in a text."""
        out = [0] * len(KINDS)
        if not text:
            return out
        low = text.lower()
        done = 0  # up to here clauses are read
        for last, size in self.match.iter(low):
            start = last - size + 1
            if start < done or start and low[start - 1].isalpha():
                continue
            begin = max(done, *(low.rfind(c, done, start) + 1 for c in ".!?;\n"))
            m = _STOP.search(low, last + 1)
            end = m.start() if m else len(low)
            state, learned = Grammar.START, 0
            for w in _WORD.finditer(low, begin, end):
                word = w[0].replace("’", "'")
                symbol = self._symbol(word)
                if symbol == "-" and word.endswith("n't"):
                    symbol = "N"
                elif symbol == "-" and "'" in word:
                    symbol = _SYMBOL.get(word.split("'")[0], "-")
                learned += symbol == "L"
                state = self.grammar.step(state, symbol)
            kind = self.grammar.kind(state)
            if kind is not None:
                out[kind] += learned or 1 if kind == 6 else 1
            done = end
        return out


def score(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Probability of the toxic label from a text's features."""
    z = weights[0] + np.log1p(np.asarray(counts, float).reshape(-1, len(weights) - 1)) @ weights[1:]
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(counts: np.ndarray, labels: np.ndarray, strength: float = 0.5, steps: int = 50) -> np.ndarray:
    """Weights by penalised logistic regression (Newton steps), drawn towards
    ``PRIOR``: kinds without labelled examples keep their fixed weight."""
    w = PRIOR.copy()
    if not len(labels):
        return w
    x = np.hstack([np.ones((len(labels), 1)), np.log1p(counts.astype(float))])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ (labels - p) - strength * (w - PRIOR)
        hess = (x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w = w + move
        if np.abs(move).max() < 1e-8:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    train, rows: int) -> DataFrame:
    """``(text, y)``: texts of at most ``rows`` labelled ids a class (those of
    smallest id hash) among the ids that ``train`` admits.  Ids with
    contradicting labels are left out; equal texts count once."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("y")) \
        .filter(F.col("_id").isNotNull() & F.col("y").isin(0, 1)).filter(train(F.col("_id"))) \
        .groupBy("_id").agg(F.min("y").alias("y"), F.max("y").alias("_max")) \
        .filter(F.col("y") == F.col("_max")).select("_id", "y")
    some = None
    for y in (0, 1):
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("_id"), "_id").limit(rows)
        some = part if some is None else some.unionAll(part)
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("text"))
    # the sample's ids are bounded by `rows` a class
    return texts.join(F.broadcast(some), "_id").filter(F.col("text").isNotNull()) \
        .groupBy(F.sha2("text", 256).alias("_h")).agg(F.first("text").alias("text"), F.max("y").alias("y")) \
        .select("text", "y")


def candidate_stems(sample: DataFrame, sizes: tuple[int, ...] = tuple(range(4, 11)), min_contexts: int = 3,
                    lift: float = 4.0, max_stems: int = 2000) -> list[str]:
    """Word beginnings ``lift`` times as common in the sample's toxic texts as
    in its clean ones, best first (by support times log lift).

    A stem's support is the number of different (word, word before) pairs in
    the texts, so copies of one text count once.  At most ``max_stems`` rows
    come to the driver.
    """
    tokens = sample.select("y", F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)).alias("w"))
    both = F.arrays_zip(F.col("w").alias("word"), F.concat(F.array(F.lit("")), F.col("w")).alias("prior"))
    pairs = tokens.select("y", F.explode(both).alias("p")).select("y", "p.word", "p.prior") \
        .filter(F.length("word") >= min(sizes)).distinct()
    words = pairs.groupBy("word").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean"))
    all_ = words.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).first()
    if not all_["t"]:
        return []
    ends = F.array_distinct(F.array(*[F.substring("word", 1, n) for n in sizes]))
    rate = (F.col("toxic") / F.lit(float(all_["t"]))) / ((F.col("clean") + 0.5) / F.lit(float((all_["c"] or 0) + 1)))
    stems = words.select(F.explode(ends).alias("stem"), "toxic", "clean").groupBy("stem") \
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")) \
        .filter((F.col("toxic") >= min_contexts) & (rate >= lift)) \
        .orderBy((F.col("toxic") * F.log(rate)).desc(), F.length("stem").desc(), "stem").limit(max_stems)
    return [r["stem"] for r in stems.select("stem").collect()]


def learned_stems(sample: DataFrame, min_share: float = 0.002, min_texts: int = 2, repeats: int = 2,
                  clean_share: float = 0.1) -> list[str]:
    """Stems that explain toxic texts the fixed lexicon does not reach.

    A text counts for a stem when the stem begins ``repeats`` of its words:
    one alone may be chance.  Greedy cover: the stem of most toxic texts not
    yet reached is taken (the longest of equals) while these are
    ``min_texts`` and ``min_share`` of the toxic texts at least, and clean
    texts count for it at most ``clean_share`` times as often as toxic ones.
    Words that come with a copied text explain no more than the stem already
    taken for it.  The sample, and so the rows that come to the driver, are
    bounded.
    """
    stems = candidate_stems(sample)
    if not stems:
        return []

    def scan(batches):
        fixed, own = Scorer([]), Scorer(stems)
        number = {s: i for i, s in enumerate(stems)}
        for b in batches:
            reached, found = [], []
            for t in b.column(1).to_pylist():
                low, times = t.lower(), {}
                for last, size in own.match.iter(low):
                    start = last - size + 1
                    n = number.get(low[start:last + 1])
                    if n is not None and not (start and low[start - 1].isalpha()):
                        times[n] = times.get(n, 0) + 1
                reached.append(any(fixed.counts(t)))
                found.append(sorted(n for n, k in times.items() if k >= repeats))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(reached, pa.bool_()), pa.array(found, pa.list_(pa.int32()))],
                ["y", "reached", "stems"])

    texts = sample.select("y", "text").mapInArrow(scan, "y int, reached boolean, stems array<int>").collect()
    with_stem: list[set[int]] = [set() for _ in stems]
    clean = [0] * len(stems)
    for i, r in enumerate(texts):
        for s in r["stems"]:
            if r["y"]:
                with_stem[s].add(i)
            else:
                clean[s] += 1
    n_toxic = sum(r["y"] for r in texts)
    n_clean = max(1, len(texts) - n_toxic)
    open_ = {i for i, r in enumerate(texts) if r["y"] and not r["reached"]}
    least = max(min_texts, math.ceil(min_share * n_toxic))
    left = [s for s in range(len(stems)) if clean[s] / n_clean <= clean_share * len(with_stem[s]) / max(1, n_toxic)]
    out: list[str] = []
    while left and open_:
        best = max(left, key=lambda s: (len(with_stem[s] & open_), len(stems[s]), -s))
        if len(with_stem[best] & open_) < least:
            break
        out.append(stems[best])
        open_ -= with_stem[best]
        left.remove(best)
    return out


def clause_counts(docs: DataFrame, text_col: str, stems: list[str], weights: np.ndarray | None = None,
                  column: str = "score") -> DataFrame:
    """``docs`` with a score column (or, without weights, the features as an
    array) in place of ``text_col``; rows are independent."""
    at = docs.columns.index(text_col)
    keep = [i for i in range(len(docs.columns)) if i != at and docs.columns[i] != column]
    key = f"toxicity:{hash(tuple(stems))}"

    def scan(batches):
        scorer = worker_state(key, lambda: Scorer(stems))
        for b in batches:
            counts = [scorer.features(t.as_py()) for t in b.column(at)]
            new = pa.array(counts, pa.list_(pa.float64())) if weights is None else pa.array(score(counts, weights))
            yield pa.RecordBatch.from_arrays([b.column(i) for i in keep] + [new],
                                             [b.schema.names[i] for i in keep] + [column])

    from pyspark.sql import types as T

    kind = T.ArrayType(T.DoubleType()) if weights is None else T.DoubleType()
    schema = T.StructType([docs.schema.fields[i] for i in keep] + [T.StructField(column, kind)])
    return docs.mapInArrow(tidy(scan), schema)


def learn(docs: DataFrame, labels: DataFrame, work: WorkFolder, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", train=lambda _: F.lit(True), rows: int = 4000) -> tuple[list[str], np.ndarray]:
    """``(stems, weights)`` from at most ``rows`` labelled texts a class."""
    sample = work.save(labelled_sample(docs, labels, id_col, text_col, label_col, train, rows), "sample")
    stems = learned_stems(sample)
    got = clause_counts(sample.select("y", "text"), "text", stems, column="counts").collect()  # bounded by the sample
    work.drop(sample)
    counts = np.array([r["counts"] for r in got], float).reshape(-1, len(PRIOR) - 1)
    return stems, fit(counts, np.array([r["y"] for r in got], float))


def toxicity(docs: DataFrame, labels: DataFrame, work: WorkFolder, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", train=lambda _: F.lit(True), rows: int = 4000,
             threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold``
    on) in place of the text, for every row.

    Only the text is scored.  Null and empty texts have no clause and get the
    score of that.  Without usable labels the fixed lexicon and weights hold.
    Rows with equal texts get equal scores; null ids pass; input columns named
    like an output are replaced.
    """
    stems, weights = learn(docs, labels, work, id_col, text_col, label_col, train, rows)
    scored = clause_counts(docs.drop("score", "predicted"), text_col, stems, weights)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _text_key(text) -> list:
    """Two 64-bit hashes that stand for a text."""
    return [F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(1), text).alias("_k2")]


def reject_toxic(docs: DataFrame, labels: DataFrame, work: WorkFolder, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", rows: int = 4000, threshold: float = 0.7,
                 broadcast_rows: int = 2_000_000) -> DataFrame:
    """``docs`` without the rows whose text scores ``threshold`` or more; all
    columns stay as they are, repeated rows are repeated, no rows give no rows.

    Texts are scored in Python, but no row passes through it: the keys (128-bit
    hashes) of the rejected texts come back and are taken out by an anti join,
    broadcast while there are at most ``broadcast_rows``.
    """
    work = work.scope()
    stems, weights = learn(docs, labels, work, id_col, text_col, label_col, rows=rows)
    text = F.col(f"`{text_col}`")
    scored = clause_counts(docs.select(*_text_key(text), text.alias("text")), "text", stems, weights)
    out = work.save(scored.filter(F.col("score") >= threshold).select("_k1", "_k2").distinct(), "rejected")
    gone = F.broadcast(out) if out.count() <= broadcast_rows else out
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, *_text_key(text)).join(gone, ["_k1", "_k2"], "left_anti").select("row.*")
