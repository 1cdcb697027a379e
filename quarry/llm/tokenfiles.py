"""Token ids as flat binary files with 64-bit document offsets.

Format (little-endian, one set of files a partition, documents in ascending
id order over all partitions):

* ``ids-*.bin``      the token ids, unsigned, 2 or 4 bytes each;
* ``offsets-*.bin``  unsigned 64-bit, where each document's ids begin in the
                     partition's id file, and one more for the end;
* ``docs-*.bin``     signed 64-bit document ids, in the same order;
* ``manifest``       a Parquet table, one row a partition: file names, counts,
                     and ``base``, the number of ids in all partitions before.

A partition's base comes from a prefix sum over the manifest's counts, so
writing needs no coordination.  Every attempt of a task writes files of its
own and names them in its manifest row; only rows of attempts that Spark
commits are in the table, so lost executors and retries leave no trace in
what is read.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WorkFolder
from quarry.llm.tokens import documents

_PART = "part int, ids string, offsets string, docs string, width int, n_docs long, n_null long, n_ids long"


def _store(path: str):
    """The file system of a folder's URI and the path there."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _view(store, path: str, kind: str) -> np.ndarray:
    """A flat file as an array: memory-mapped where the store is a local or
    mounted folder, read as one buffer elsewhere."""
    if store.type_name == "local":
        if not store.get_file_info(path).size:
            return np.zeros(0, kind)
        return np.memmap(path, dtype=kind, mode="r")
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), dtype=kind)


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None, end_id: int | None = 2, width: int = 2) -> DataFrame:
    """Encode every text, write the files into ``folder`` and return the parts
    (the manifest without bases) -- a lazy frame that writes when it runs, so
    save it once (:func:`save_tokens` does).

    ``width``: bytes an id (2 holds vocabularies below 65,536; an id that does
    not fit raises).  Null texts are empty; rows repeating an id are documents
    of their own, ordered by their text; null ids come first.  Rows are ranged
    over partitions by id and then text hash, so no id is bound to one task.
    """
    kind = {2: "<u2", 4: "<u4"}[width]
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")) \
        .repartitionByRange("id", F.xxhash64("text")) \
        .sortWithinPartitions("id", F.xxhash64("text"))

    def write(batches):
        store, at = _store(folder)
        store.create_dir(at, recursive=True)
        name = uuid.uuid4().hex
        n_docs = n_null = n_ids = 0
        names = {k: f"{k}-{name}.bin" for k in ("ids", "offsets", "docs")}
        out = {k: store.open_output_stream(f"{at}/{f}") for k, f in names.items()}
        try:
            for part, ids, offsets in documents(batches, "text", vocabulary, end_id):
                if len(ids) and int(ids.max()) >> (8 * width):
                    raise ValueError(f"a token id does not fit {width} bytes")
                key = part.column(0)
                out["ids"].write(ids.astype(kind).tobytes())
                out["offsets"].write((n_ids + offsets[:-1]).astype("<u8").tobytes())
                out["docs"].write(key.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                n_null += key.null_count
                n_docs += part.num_rows
                n_ids += len(ids)
            out["offsets"].write(np.array([n_ids], "<u8").tobytes())
        finally:
            for f in out.values():
                f.close()
        yield pa.RecordBatch.from_pylist([{
            "part": TaskContext.get().partitionId(), **names, "width": width,
            "n_docs": n_docs, "n_null": n_null, "n_ids": n_ids}],
            schema=pa.schema([("part", pa.int32()), ("ids", pa.string()), ("offsets", pa.string()),
                              ("docs", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()),
                              ("n_null", pa.int64()), ("n_ids", pa.int64())]))

    return rows.mapInArrow(write, _PART)


def save_tokens(docs: DataFrame, work: WorkFolder, **options) -> tuple[DataFrame, str]:
    """Write the files and the manifest; returns ``(manifest, folder)``."""
    folder = work.child("tokens")
    parts = work.save(write_tokens(docs, folder, **options), "parts")
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    return work.save(parts.withColumn("base", F.coalesce(F.sum("n_ids").over(order), F.lit(0))), "manifest"), folder


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Documents from the files: ``(doc_id, start, n_tokens, ids_crc32)``.

    ``start`` counts the ids of all documents before; the checksum is over the
    ids as little-endian unsigned 32-bit numbers, whatever their width in the
    file.  Each partition's files are mapped and read document by document.
    """
    def read(batches):
        store, at = _store(folder)
        for b in batches:
            for r in b.to_pylist():
                ids = _view(store, f"{at}/{r['ids']}", f"<u{r['width']}")
                offsets = _view(store, f"{at}/{r['offsets']}", "<u8").astype(np.int64)
                docs = _view(store, f"{at}/{r['docs']}", "<i8")
                for lo in range(0, r["n_docs"], 8192):
                    hi = min(r["n_docs"], lo + 8192)
                    crc = [zlib.crc32(ids[offsets[i]:offsets[i + 1]].astype("<u4").tobytes()) for i in range(lo, hi)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.array(docs[lo:hi]), mask=np.arange(lo, hi) < r["n_null"]),
                        pa.array(r["base"] + offsets[lo:hi]), pa.array(np.diff(offsets[lo:hi + 1])),
                        pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    parts = max(1, manifest.count())  # one row a partition; a part's files are one task's work
    spread = manifest.repartition(parts, F.col("part"))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
