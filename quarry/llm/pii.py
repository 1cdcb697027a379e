"""Personal data, also disguised: deobfuscation that keeps source positions.

Transducers rewrite a text piece by piece -- look-alike and full-width
characters to ASCII, invisible ones to nothing, spelled digits to digits,
"(at)" and "dot" to their signs -- and every rewritten piece remembers the
source characters it came from.  The identifiers are found in the source
and in the rewritten text; spans of the latter map back to source positions.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.spans import tidy

KINDS = ("email", "ip", "card", "phone")


class Span(NamedTuple):
    kind: str
    start: int  # code points
    end: int
    added: bool  # found in the rewritten text only


# ------------------------------------------------------------------ detectors

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# possessive forms of the contract's patterns: nothing in them can match by giving characters back
# (an address begins a run of digits: where the first digit fails, a later one of the run fails as well)
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){12,}+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str):
    """Left-most matches of the e-mail pattern, found from their at signs, so
    that a long run of name characters is read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        end = at + 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = end = m.end()
        else:
            done = at + 1
        at = text.find("@", end)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def identifiers(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by the patterns as they stand, left-most and
    non-overlapping within a kind; matches that fail their test are dropped."""
    out = [("email", s, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if len(d) <= 19 and _luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# ---------------------------------------------------------------- transducers

#: Cyrillic and Greek letters drawn like Latin ones.
_LOOKALIKE = dict(zip("аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅοανρυικΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
                      "aeopcyxijshdqwABEKMHOPCTYXIJSoavpuikABEZHIKMNOPTYX", strict=True))
#: The digits' names in the corpus's languages (English, German, French, Spanish).
_DIGIT_NAMES = {
    "0": "zero oh null zéro cero", "1": "one eins un uno", "2": "two zwei deux dos", "3": "three drei trois tres",
    "4": "four vier quatre cuatro", "5": "five fünf cinq cinco", "6": "six sechs seis", "7": "seven sieben sept siete",
    "8": "eight acht huit ocho", "9": "nine neun neuf nueve"}
_DIGIT = {name: d for d, names in _DIGIT_NAMES.items() for name in names.split()}
_NAME = "|".join(sorted(_DIGIT, key=len, reverse=True))
_DOT = "dot|punkt|point|punto"
#: The at sign's names, read between brackets.
_AT = "at|arobase|arroba|bei"
_GAP = rf"(?:[ \t]*[,-]?[ \t]+(?:(?:{_DOT})[ \t]+)?|-)"
#: A run of at least four digits, named or written, that names one at least (checked on use).
_SPELLED = re.compile(rf"(?:(?<![^\W_])plus{_GAP})?(?<![^\W_])(?:{_NAME})(?:{_GAP}(?:{_NAME}|[0-9]))" r"{3,}(?![^\W_])")
_ITEM = re.compile(rf"(?P<name>{_NAME})(?![^\W_])|(?P<plus>plus)|(?P<dot>{_DOT})|(?P<digit>[0-9])|.", re.S)
#: Signs in brackets, and bare between words; "at" needs a disguised dot after the name that follows.
_HIDDEN_DOT = rf"(?:[ \t]+(?:{_DOT})[ \t]+|[ \t]*[\[({{<][ \t]*(?:{_DOT}|\.)[ \t]*[\])}}>]|[_-]dot[_-])"
_SIGN = re.compile(
    rf"[\[({{<][ \t]*(?:(?P<at>{_AT}|@)|(?P<dot>{_DOT}|\.))[ \t]*[\])}}>]"
    rf"|(?<=[ \t])(?P<at2>at)(?=[ \t]+[a-z0-9-]+{_HIDDEN_DOT}[ \t]*[a-z0-9])"
    rf"|(?<=[a-z0-9])(?P<at3>[_-]at[_-])(?=[a-z0-9-]+?{_HIDDEN_DOT}[ \t]*[a-z0-9])"
    rf"|(?<=[ \t])(?P<dot2>{_DOT})(?=[ \t]+[a-z0-9])|(?<=[a-z0-9])(?P<dot3>[_-]dot[_-])(?=[a-z0-9])")
_SIGN_HINT = re.compile(rf"{_DOT}|[\[({{<][ \t]*(?:{_AT}|@|\.)")
_BEYOND = re.compile("[­ʰ-\U0010ffff]")
_KEPT = frozenset("@._%+-() ")


@lru_cache(maxsize=4096)
def _plain(c: str) -> str | None:
    """ASCII for a look-alike or compatibility character, "" for an invisible
    one, None for what stays as it is."""
    if c in _LOOKALIKE:
        return _LOOKALIKE[c]
    if unicodedata.category(c) == "Cf":
        return ""
    digit = unicodedata.digit(c, None)
    if digit is not None:
        return str(digit)
    if unicodedata.category(c) == "Zs":
        return " "
    flat = unicodedata.normalize("NFKC", c)
    return flat if len(flat) == 1 and flat < "\x80" and (flat.isalnum() or flat in _KEPT) else None


class Rewritten:
    """A text after rewriting, as pieces that know their source."""

    def __init__(self, source: str):
        self.text = source
        self.arcs: list[tuple[int, int, str]] = []  # source start, end, replacement; ascending
        self._starts: list[int] = []
        self._shift: list[int] = []

    def apply(self, arcs: list[tuple[int, int, str]], source: str) -> None:
        self.arcs = arcs
        out, at, length = [], 0, 0
        self._starts, self._shift = [], []
        for s, e, new in arcs:
            out.append(source[at:s])
            length += s - at
            self._starts.append(length)
            out.append(new)
            length += len(new)
            at = e
        out.append(source[at:])
        self.text = "".join(out)

    def back(self, start: int, end: int) -> tuple[int, int, bool]:
        """Source span of a span here, and whether a rewritten piece lies in it."""
        def locate(p: int, last: bool) -> int:
            i = bisect.bisect_right(self._starts, p) - 1
            while i >= 0 and not self.arcs[i][2] and self._starts[i] == p:
                i -= 1  # deleted pieces hold no character
            if i < 0:
                j = bisect.bisect_right(self._starts, p)
                first = self.arcs[0] if self.arcs else None
                return p + last if first is None or j == 0 else self._plain_at(p, j - 1, last)
            s, e, new = self.arcs[i]
            if p < self._starts[i] + len(new):
                return e if last else s
            return self._plain_at(p, bisect.bisect_right(self._starts, p) - 1, last)

        a, b = locate(start, False), locate(end - 1, True)
        i = bisect.bisect_left(self.arcs, (a,))
        return a, b, i < len(self.arcs) and self.arcs[i][0] < b

    def _plain_at(self, p: int, i: int, last: bool) -> int:
        s, e, new = self.arcs[i]
        return e + p - (self._starts[i] + len(new)) + last


def _compose(first: Rewritten, arcs: list[tuple[int, int, str]], source: str) -> Rewritten:
    """``arcs`` over ``first.text`` after the arcs of ``first``: one rewriting of ``source``."""
    whole: list[tuple[int, int, str]] = []
    taken = 0
    for s, e, new in arcs:
        a, b, _ = first.back(s, e)
        while taken < len(first.arcs) and first.arcs[taken][1] <= a:
            whole.append(first.arcs[taken])
            taken += 1
        while taken < len(first.arcs) and first.arcs[taken][0] < b:
            taken += 1
        whole.append((a, b, new))
    whole += first.arcs[taken:]
    out = Rewritten(source)
    out.apply(whole, source)
    return out


def rewrite(text: str) -> Rewritten | None:
    """The text without its disguises; None if it has none."""
    chars = []
    if not text.isascii():
        for m in _BEYOND.finditer(text):
            new = _plain(m[0])
            if new is not None:
                chars.append((m.start(), m.end(), new))
    one = Rewritten(text)
    if chars:
        one.apply(chars, text)
    low = one.text.lower()
    if len(low) != len(one.text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in one.text)
    arcs: list[tuple[int, int, str]] = []
    for m in _SPELLED.finditer(low):
        for x in _ITEM.finditer(low, m.start(), m.end()):
            kind = x.lastgroup
            if kind == "digit":
                continue
            new = {"name": lambda: _DIGIT[x[0]], "plus": lambda: "+", "dot": lambda: "."}.get(kind, lambda: "")()
            arcs.append((x.start(), x.end(), new))
    if _SIGN_HINT.search(low):
        runs = [(m.start(), m.end()) for m in _SPELLED.finditer(low)] if arcs else []
        for m in _SIGN.finditer(low):
            s, e = m.start(), m.end()
            while s > 0 and low[s - 1] in " \t":
                s -= 1
            while e < len(low) and low[e] in " \t":
                e += 1
            k = bisect.bisect_right(runs, (s, len(low) + 1)) - 1
            if k >= 0 and runs[k][1] > s:
                continue  # inside spelled digits
            if arcs and s < max((a[1] for a in arcs[-1:]), default=0) and not runs:
                continue
            arcs.append((s, e, "@" if m.lastgroup.startswith("at") else "."))
    if not arcs:
        return one if chars else None
    arcs.sort()
    clean: list[tuple[int, int, str]] = []
    for arc in arcs:
        if not clean or arc[0] >= clean[-1][1]:
            clean.append(arc)
    return _compose(one, clean, text)


def find(text: str | None) -> list[Span]:
    """All spans of a text, by kind as in ``KINDS``, then start and end.  Base
    spans are the patterns' own; a span of the rewritten text is added when a
    disguise lies in it and no base span of its kind covers it."""
    if not text:
        return []
    base = identifiers(text)
    spans = [Span(k, s, e, False) for k, s, e in base]
    plain = rewrite(text)
    if plain is not None:
        # base spans of a kind ascend and do not overlap: one at most can cover a span
        starts = {k: [x for kind, x, _ in base if kind == k] for k in KINDS}
        ends = {k: [y for kind, _, y in base if kind == k] for k in KINDS}
        for kind, s, e in identifiers(plain.text):
            a, b, changed = plain.back(s, e)
            i = bisect.bisect_right(starts[kind], a) - 1
            if changed and not (i >= 0 and b <= ends[kind][i]):
                spans.append(Span(kind, a, b, True))
    return sorted(set(spans), key=lambda x: (KINDS.index(x.kind), x.start, x.end))


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span replaced by its kind in angle brackets; spans
    that overlap go as one, under the name of the first."""
    if not spans or text is None:
        return text
    out, at = [], 0
    for s in sorted(spans, key=lambda x: (x.start, -x.end)):
        if s.start >= at:
            out += [text[at:s.start], f"<{s.kind.upper()}>"]
        at = max(at, s.end)
    return "".join(out) + text[at:]


# ------------------------------------------------------------------ operators

def _listed(spans) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: ``doc_id``, the base matches of each kind ``n_email,
    n_ip, n_card, n_phone``, ``base_sha256`` of their list, ``spans`` (base and
    added, ``kind:start:end`` joined by commas) and ``n_added``.

    Positions are code points of the whole text, end exclusive.  Null and
    empty texts have no spans; null ids and repeated rows pass through, a row
    each; extra columns are ignored.  Rows are independent: no shuffle.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def scan(batches):
        for b in batches:
            counts = {k: [] for k in KINDS}
            digest, listed, added = [], [], []
            for t in b.column(1):
                found = find(t.as_py())
                base = [s for s in found if not s.added]
                for k in KINDS:
                    counts[k].append(sum(s.kind == k for s in base))
                digest.append(hashlib.sha256(_listed(base).encode()).hexdigest())
                listed.append(_listed(found))
                added.append(len(found) - len(base))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(counts[k], pa.int64()) for k in KINDS], pa.array(digest, pa.string()),
                 pa.array(listed, pa.string()), pa.array(added, pa.int64())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"])

    return rows.mapInArrow(scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                 "base_sha256 string, spans string, n_added long")


def redact_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced by its kind; every
    row and column stays, null texts stay null."""
    at = docs.columns.index(text_col)

    def clean(batches):
        for b in batches:
            texts = pa.array([redact(t, find(t)) for t in (x.as_py() for x in b.column(at))], b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([texts if i == at else b.column(i) for i in range(b.num_columns)],
                                             schema=b.schema)

    return docs.mapInArrow(tidy(clean), docs.schema)
