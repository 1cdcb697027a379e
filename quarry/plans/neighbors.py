"""kNN classification (C17) on the driver's tables.

Roles: the wine rows are the ``embeddings`` vectors, the quality is
``label``; the distance records are produced from the vectors by the
library's exact pivot-cell kNN (Euclidean, both directions, no self).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import neighbors as nb
from quarry.sources import table

# Fixed value: the job parameter k.
K = 5


def knn_neighbors(spark: SparkSession, sf: str) -> DataFrame:
    """The 5 nearest other vectors of every vector, with their distances."""
    near = nb.nearest_vectors(table(spark, sf, "embeddings"), K, id_col="vec_id", vec_col="embedding")
    return near.select("id", "paired", F.round("distance", 9).alias("distance"))


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    emb = table(spark, sf, "embeddings")
    near = nb.nearest_vectors(emb, K, id_col="vec_id", vec_col="embedding")
    labels = emb.select(F.col("vec_id").alias("id"), "label")
    return nb.knn_classify(near, labels)


def knn_confusion(spark: SparkSession, sf: str) -> DataFrame:
    """C17: confusion matrix (predicted, actual, n) of 5-NN majority vote."""
    return nb.confusion_matrix(_predictions(spark, sf))


def knn_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy of the same classifier, one row."""
    return nb.accuracy(_predictions(spark, sf))


def knn_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    """J7, J8 for rows that are not in the labelled table: every vector at half
    its length, classified by its 5 nearest of all labelled vectors."""
    emb = table(spark, sf, "embeddings")
    new = emb.select(F.col("vec_id").alias("new_id"),
                     F.transform(F.col("embedding").cast("array<double>"), lambda x: x * 0.5).alias("half"))
    near = nb.nearest_between(new, emb, K, query_id="new_id", query_vec="half", ref_id="vec_id", ref_vec="embedding")
    return nb.knn_vote(near, emb.select(F.col("vec_id").alias("id"), "label"))


QUERIES = {"knn_neighbors": knn_neighbors, "knn_confusion": knn_confusion, "knn_accuracy": knn_accuracy,
           "knn_new_rows": knn_new_rows}

_PRED = f"""
    WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
         d AS (SELECT a.vec_id AS id, b.vec_id AS paired, b.label AS nlabel,
                      list_distance(a.v, b.v) AS dist
               FROM e a JOIN e b ON a.vec_id <> b.vec_id),
         nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, paired) AS r
                               FROM d) x WHERE r <= {K}),
         votes AS (SELECT id, nlabel, COUNT(*) AS n FROM nn GROUP BY 1, 2),
         pred AS (SELECT id, nlabel AS predicted FROM (
                    SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, nlabel) AS r FROM votes) y
                  WHERE r = 1),
         p AS (SELECT pred.id, predicted, e.label AS actual FROM pred JOIN e ON e.vec_id = pred.id)"""

ORACLE = {
    "knn_neighbors": f"""
        WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
             d AS (SELECT a.vec_id AS id, b.vec_id AS paired, list_distance(a.v, b.v) AS dist
                   FROM e a JOIN e b ON a.vec_id <> b.vec_id)
        SELECT id, paired, round(dist, 9) AS distance FROM (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, paired) AS r FROM d) x WHERE r <= {K}""",
    "knn_new_rows": f"""
        WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
             q AS (SELECT vec_id AS id, list_transform(v, lambda x: x * 0.5) AS v FROM e),
             d AS (SELECT q.id, e.vec_id AS paired, e.label, list_distance(q.v, e.v) AS dist FROM q CROSS JOIN e),
             nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, paired) AS r FROM d) x
                    WHERE r <= {K}),
             votes AS (SELECT id, label, COUNT(*) AS n FROM nn GROUP BY 1, 2)
        SELECT id, label AS predicted FROM (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, label) AS r FROM votes) y WHERE r = 1""",
    "knn_confusion": _PRED + " SELECT predicted, actual, COUNT(*) AS n FROM p GROUP BY 1, 2",
    "knn_accuracy": _PRED + """ SELECT AVG(CASE WHEN predicted = actual THEN 1.0 ELSE 0.0 END)::DOUBLE AS accuracy,
                                       COUNT(*) AS n FROM p""",
}
