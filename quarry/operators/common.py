"""Intermediate tables shared by the operators."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

_OPEN: list[Scratch] = []


class Scratch:
    """Intermediate Parquet tables of one operator, in a folder of their own.

    The folder lies below ``base``, or below ``spark.checkpoint.dir`` (shared
    storage on a cluster).  A table read by several branches of a plan is
    computed once; its lineage is cut, so a lost executor costs a re-read of
    shared storage, not a recomputation; and, unlike an RDD checkpoint, it
    carries its real size for the planner.

    Writing runs a job.  A result still reads its tables, so whoever uses the
    result calls :meth:`release` afterwards; what is not released goes when
    the driver exits.
    """

    def __init__(self, spark: SparkSession, base: str | None = None):
        self.spark = spark
        self.path = f"{(base or ensure_checkpoint_dir(spark)).rstrip('/')}/quarry-{uuid.uuid4().hex}"
        self._tables: dict[int, str] = {}
        _OPEN.append(self)

    def save(self, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        path = self.child()
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._tables[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete saved tables that no later step reads.  The JVM then collects
        its garbage, so that the shuffle files of ended steps go, too."""
        for t in tables:
            self._delete(self._tables.pop(id(t)))
        self.spark.sparkContext._jvm.System.gc()

    def child(self) -> str:
        """A path of this folder that nothing uses yet."""
        return f"{self.path}/{uuid.uuid4().hex}"

    def release(self) -> None:
        """Delete everything in this folder."""
        self._delete(self.path)
        if self in _OPEN:
            _OPEN.remove(self)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def ranked(df: DataFrame, order: list[Column | str], scratch, name: str = "rank") -> DataFrame:
    """``df`` with every row's place (from 0) in ``order``, without a one-task sort.

    Rows are ranged over partitions and saved in order (``scratch.save``); a
    partition's base is the prefix sum over one row a partition.  Rows equal in
    ``order`` stay in one partition: end it with a column that tells them apart
    if many can be equal.
    """
    place = F.monotonically_increasing_id()
    saved = scratch.save(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", place))
    part = F.shiftright("_at", 33)
    sizes = saved.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    bases = sizes.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    # the bases are broadcast: one row a partition of the exchange
    return saved.join(F.broadcast(bases), part == F.col("_part")).select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("_base") + F.col("_at") - F.col("_first")).cast("long").alias(name))


@atexit.register
def _release_all() -> None:
    for scratch in list(_OPEN):
        try:
            scratch.release()
        except Exception:  # the session ended first
            _OPEN.remove(scratch)
