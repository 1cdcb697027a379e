"""Helpers shared by the operators of this subpackage.

* :class:`WorkFolder` -- intermediates as Parquet in the shared folder that
  ``spark.checkpoint.dir`` names, dropped as soon as they are superseded;
* :func:`spread_rank` -- gapless ranks inside groups of any size;
* :func:`components` -- connected components from an edge table.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

_OPEN: list[WorkFolder] = []


class WorkFolder:
    """A folder of intermediate tables below the session's checkpoint folder.

    ``save(df)`` writes a table and reads it back (lineage ends there, so a
    lost executor costs a re-read of shared storage); ``drop(df)`` removes one
    that no later step reads; ``release()`` removes all.  A result that a
    query returns still reads its table, so the owner calls ``release()``
    after using it; folders not released by then go when the driver exits.
    """

    def __init__(self, spark: SparkSession, base: str | None = None):
        self.spark = spark
        self.path = f"{(base or ensure_checkpoint_dir(spark)).rstrip('/')}/quarry-{uuid.uuid4().hex}"
        self._tables: dict[int, str] = {}
        _OPEN.append(self)

    def child(self, name: str) -> str:
        return f"{self.path}/{name}-{uuid.uuid4().hex[:12]}"

    def save(self, df: DataFrame, name: str = "table") -> DataFrame:
        path = self.child(name)
        df.write.mode("errorifexists").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._tables[id(out)] = path
        return out

    def scope(self) -> WorkFolder:
        """A folder inside this one, for an operator's own tables."""
        return WorkFolder(self.spark, self.path)

    def keep(self, *tables: DataFrame) -> None:
        """Remove every table of this folder that is not named."""
        held = {self._tables.get(id(t)) for t in tables}
        for key, path in list(self._tables.items()):
            if path not in held:
                del self._tables[key]
                self._delete(path)

    def drop(self, df: DataFrame) -> None:
        path = self._tables.pop(id(df), None)
        if path:
            self._delete(path)

    def release(self) -> None:
        self._delete(self.path)
        if self in _OPEN:
            _OPEN.remove(self)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _release_all() -> None:
    for work in list(_OPEN):
        try:
            work.release()
        except Exception:  # the session may have ended first; its folder is then the cluster's to clean
            _OPEN.remove(work)


def spread_rank(df: DataFrame, group: list[str], order: list[Column], salt: Column, salts: int,
                name: str = "rank", total: str | None = None) -> DataFrame:
    """Gapless ranks from 0 inside every ``group``, without one task per group.

    A group is cut into ``salts`` parts by ``salt`` (an int column below
    ``salts``); ranks inside a part come from a window on (group, part), and
    each part starts where the parts before it end: the prefix sums run over
    the table of part sizes, at most ``salts`` rows a group.  The order is
    therefore (salt, ``order``).  ``total`` names an optional column with the
    group's size.
    """
    tagged = df.withColumn("_salt", salt)
    keys = [*group, "_salt"]
    sizes = tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    cols = [*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")]
    if total:
        cols.append(F.sum("_n").over(Window.partitionBy(*group)).alias(total))
    bases = sizes.select(*cols)
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    match = None
    for k in keys:
        same = F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}"))
        match = same if match is None else match & same
    ranked = tagged.withColumn("_inside", inside)
    extra = [F.col(f"b.{total}")] if total else []
    return ranked.alias("r").join(bases.alias("b"), match).select(
        *[F.col(f"r.`{c}`") for c in df.columns],
        (F.col("b._base") + F.col("r._inside") - 1).cast("long").alias(name), *extra)


def components(edges: DataFrame, work: WorkFolder, a: str = "a", b: str = "b",
               max_rounds: int = 64) -> DataFrame:
    """Connected components of an undirected edge table: ``(node, component)``
    for every node on an edge, the component being its smallest node.

    Alternating large-star and small-star rounds (Kiveris et al., SoCC 2014):
    a grouped minimum and an equi-join each, so no neighbourhood is gathered
    in a task; the edge set never grows and ends as a star around every
    component's smallest node.  Rounds stop when the edges no longer change
    (count and checksum); ``max_rounds`` is only a guard and raises.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def mark(e: DataFrame):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return (r[0], r[1])

    cur = work.save(edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    seen = mark(cur)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        # large star: every larger neighbour of u moves to u's smallest neighbour (or u itself)
        d = both(cur)
        low = d.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        big = d.filter(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: every smaller neighbour of u, and u, move to u's smallest neighbour
        big = big.distinct()
        low2 = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionAll(low2.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v")).distinct()
        nxt = work.save(small, "edges")
        now = mark(nxt)
        work.drop(cur)
        cur = nxt
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components: the edges still change after max_rounds")
    roots = cur.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
