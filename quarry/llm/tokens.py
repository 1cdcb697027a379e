"""Token ids of whole texts by a public word-level vocabulary.

The tokenizers library encodes every distinct piece (between white space, and
cut before a stop that follows a letter) once per worker; a text's ids are its
pieces' ids in order.  That is exact for vocabularies whose pre-tokens never
cross these places and drop white space (the one used here lower-cases,
composes and splits by regular expression, all of which act inside a piece):
the tests hold it against whole-text encoding.

A text that holds the string of one of the vocabulary's special tokens goes to
the library alone and whole, which makes that token's id of it, as the library
does unless told otherwise (``special_text=True``: ordinary text).
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quarry.llm.spans import Pool, slices, text_bytes, whole_rows, words, worker_state


_UPPER, _LETTER, _STOP = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
#: Between an ASCII letter and one of these a pre-token ends, whatever follows.
_STOP[[ord(c) for c in ".,;:!?"]] = True


def vocabulary(path: str | None = None) -> str:
    """Path of the vocabulary file; the installed public one by default."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Ids of texts; one per worker process (see :func:`word_ids`)."""

    JOIN = 400  # pieces a library call
    MARK = "|"  # stands between them; its one id tells them apart

    def __init__(self, path: str, special_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.whole = lambda: Tokenizer.from_file(path)  # as it comes; made when a text needs it
        self.special = [] if special_text else [t.content for t in self.library.get_added_tokens_decoder().values()]
        # pieces are cut and lower-cased beforehand: none of them may become a special string by that
        self.library.encode_special_tokens = True
        self.mark, = self.library.encode(self.MARK, add_special_tokens=False).ids
        self.pool = Pool()

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, counts)`` of the pieces.  Many go to the library in one call
        with a mark between them; a piece that holds the mark goes alone."""
        texts = [p.decode("utf-8", "replace") for p in pieces]
        alone = [i for i, t in enumerate(texts) if self.MARK in t]
        for i, e in zip(alone, self.library.encode_batch_fast([texts[i] for i in alone], add_special_tokens=False),
                        strict=True):
            alone[alone.index(i)] = (i, np.array(e.ids, np.uint32))
        for i, _ in alone:
            texts[i] = ""
        between = f"\n{self.MARK}\n"
        lines = [between.join(texts[i:i + self.JOIN]) + between for i in range(0, len(texts), self.JOIN)]
        coded = [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(lines, add_special_tokens=False)]
        flat = np.concatenate(coded) if coded else np.zeros(0, np.uint32)
        marks = flat == self.mark
        sizes = np.diff(np.flatnonzero(marks), prepend=-1) - 1
        flat = flat[~marks]
        if alone:
            place = (np.cumsum(sizes) - sizes)[[i for i, _ in alone]]
            flat = np.insert(flat, np.repeat(place, [len(x) for _, x in alone]), np.concatenate([x for _, x in alone]))
            sizes[[i for i, _ in alone]] = [len(x) for _, x in alone]
        return flat, sizes

    def batches(self, column: pa.Array | pa.ChunkedArray, target: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(rows, ids, counts)`` a slice: rows ascending (a long text's row
        again in the next slice), each row's ids and their number."""
        alone = self._with_special(column)
        if not alone:
            yield from self._pieces(column, target)
            return
        mask = np.zeros(len(column), bool)
        mask[list(alone)] = True
        for rows, ids, counts in self._pieces(pc.if_else(pa.array(mask), "", column), target):
            here = [i for i, r in enumerate(rows.tolist()) if r in alone]
            if here:
                new = [alone[int(rows[i])] for i in here]
                place, size = (np.cumsum(counts) - counts)[here], [len(x) for x in new]
                ids = np.insert(ids, np.repeat(place, size), np.concatenate(new))
                counts = counts.copy()
                counts[here] = size
            yield rows, ids, counts

    def _with_special(self, column: pa.Array | pa.ChunkedArray) -> dict[int, np.ndarray]:
        """The ids of every text that holds a special token's string, by row."""
        rows: set[int] = set()
        for s in self.special:
            rows.update(np.flatnonzero(pc.match_substring(column, s).fill_null(False).to_numpy(zero_copy_only=False)).tolist())
        order = sorted(rows)
        if not order:
            return {}
        coded = self.whole().encode_batch([column[i].as_py() for i in order], add_special_tokens=False)
        return {i: np.array(e.ids, np.uint32) for i, e in zip(order, coded, strict=True)}

    def _pieces(self, column: pa.Array | pa.ChunkedArray, target: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        raw, offsets = text_bytes(column)
        for rows, starts, ends in slices(raw, offsets, target):
            lo, hi = int(starts[0]), int(ends[-1])
            piece = np.append(raw[lo:hi], np.uint8(0))
            # the vocabulary lower-cases; a letter that a combining mark may follow is left to the library
            piece[:-1] = np.where(_UPPER[piece[:-1]] & (piece[1:] < 0x80), piece[:-1] | 0x20, piece[:-1])
            cut = np.zeros(hi - lo, bool)
            if hi - lo > 1:
                cut[1:] = _STOP[piece[1:-1]] & _LETTER[piece[:-2]]
                heads = (starts - lo)[1:]
                cut[heads[heads < hi - lo]] = False
            start, length, part = words(piece[:-1], starts - lo, ends - lo, cut)
            ids, counts = self.pool.ids_of(piece[:-1], start, length, self.encode)
            per = np.bincount(part, weights=counts, minlength=len(rows)).astype(np.int64)
            yield rows, ids, per


def word_ids(path: str | None = None) -> WordIds:
    where = vocabulary(path)
    return worker_state(f"word_ids:{where}", lambda: WordIds(where))


def documents(batches: Iterator[pa.RecordBatch], text: str, path: str | None, end_id: int | None,
              ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """For every slice of whole documents: ``(their rows of the batch, ids, offsets)``
    with ``end_id`` after each document; a document longer than a slice is
    joined before it is given."""
    coder = word_ids(path)
    for batch in batches:
        if not batch.num_rows:
            continue
        for rows, ids, per in whole_rows(coder.batches(batch.column(batch.schema.get_field_index(text)))):
            yield _close(batch, rows, ids, per, end_id)


def _close(batch, rows, ids, per, end_id):
    ids, per = np.asarray(ids), np.asarray(per, np.int64)
    if end_id is not None:
        ids = np.insert(ids, np.cumsum(per), end_id)
        per = per + 1
    offsets = np.concatenate([[0], np.cumsum(per)])
    return batch.slice(int(rows[0]), len(rows)), ids.astype("<u4"), offsets
