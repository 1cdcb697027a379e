"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (bestfit, bpe, jaccard, lines, neardup, packing, pii, resample, search,
                        shards, tokenfiles, topk, toxicity)
from quarry.llm.common import WorkFolder


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact top 5 by integer inner product for every 50th vector."""
    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors.filter(F.col("vec_id") % 50 == 0), vectors, 5, "vec_id", "embedding")


def held_out(doc_id: Column) -> Column:
    """The third of the ids that labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents; labels learned from rows not held out."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.toxicity(docs, _read(spark, sf_dir, "labels"), WorkFolder(spark),
                            train=lambda i: ~held_out(i), rows=4000, threshold=0.7)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut into sequences of 2048 token ids, planned as a cutting-stock problem."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, WorkFolder(spark), capacity=2048, end_id=1)


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings of one label linked from a cosine of 0.98 on."""
    return neardup.near_vectors(_read(spark, sf_dir, "embeddings"), WorkFolder(spark), threshold=0.98)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in classes of 5-word shingle sets with a Jaccard similarity of 0.8 or more."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.near_duplicates(docs, WorkFolder(spark), k=5, percent=80) \
        .select("doc_id", "n_shingles", "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand on over 8 % of their site's different texts."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = lines.drop_boilerplate(docs, "source", "text", WorkFolder(spark), ratio=0.08, min_pages=3,
                                 dropped="lines_dropped")
    return out.select("doc_id", "source", "text", "lines_dropped")


def op7_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on a ring of 40 shards with loads at most one row apart."""
    text = F.coalesce(F.encode(F.col("text"), "UTF-8"), F.lit(b""))
    docs = _read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"))
    out = shards.ring_shards(docs, ["doc_id"], shards=40, virtual_nodes=64)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token-id files with 64-bit offsets, written and read back."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    manifest, folder = tokenfiles.save_tokens(docs, WorkFolder(spark), end_id=2, width=2)
    return tokenfiles.read_tokens(manifest, folder)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents, disguised or not, by source positions."""
    return pii.pii_spans(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by a byte-level BPE vocabulary, and decoded again."""
    return bpe.bpe_digests(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of all documents drawn towards the benchmark's distribution of words and pairs."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    target = _read(spark, sf_dir, "benchmark").select("text")
    return resample.importance_resample(docs, target, WorkFolder(spark), percent=25, min_words=20, buckets=10_000,
                                        seed="7")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    items = _read(spark, sf_dir, "benchmark").select("item_id", "text")
    return search.ranked_search(docs, items, WorkFolder(spark), k=20)


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed whole into sequences of 4096 token ids, best fit in rounds."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return bestfit.best_fit(docs, WorkFolder(spark), capacity=4096, end_id=1)


QUERIES = {f.__name__: f for f in (op1_topk, op2_toxicity, op3_packing, op4_near_vectors, op5_jaccard_join,
                                  op6_line_dedup, op7_ring_shards, op8_token_files, op9_pii,
                                  op10_byte_bpe, op11_importance_resample, op12_ranked_search, op13_best_fit)}

ORACLE = {
    "op1_topk": """
        WITH e AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM (SELECT DISTINCT vec_id, embedding FROM embeddings)
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
            max(CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT)) AS score
          FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
          WHERE q.vec_id % 50 = 0 GROUP BY ALL),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
              FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op6_line_dedup": """
        WITH l AS (
          SELECT doc_id, source, text, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
                 unnest(string_split(text, chr(10))) AS line
          FROM documents WHERE text IS NOT NULL),
        k AS (SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS key FROM l),
        n AS (SELECT source, count(DISTINCT text) + coalesce(max(CASE WHEN text IS NULL THEN 1 END), 0) AS pages
              FROM documents GROUP BY source),
        b AS (
          SELECT c.source, c.key FROM (
            SELECT source, key, count(*) AS n FROM (SELECT DISTINCT text, source, key FROM k WHERE key <> '')
            GROUP BY source, key) c
          JOIN n ON n.source IS NOT DISTINCT FROM c.source
          WHERE c.n >= 3 AND c.n > CAST(0.08 AS DOUBLE) * n.pages),
        m AS (
          SELECT k.doc_id, k.pos, k.line, b.key IS NOT NULL AS cut
          FROM k LEFT JOIN b ON b.source IS NOT DISTINCT FROM k.source AND b.key = k.key),
        d AS (
          SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT cut), '') AS text,
                 count(*) FILTER (WHERE cut) AS lines_dropped
          FROM m GROUP BY doc_id)
        SELECT documents.doc_id, documents.source, d.text, coalesce(d.lines_dropped, 0) AS lines_dropped
        FROM documents LEFT JOIN d USING (doc_id)""",
    "op11_importance_resample": r"""
        WITH tab AS (
          SELECT list(v ORDER BY i) AS t FROM (
            SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
                     CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
            FROM range(256) r(i))),
        texts AS (SELECT TRUE AS doc, doc_id AS id, text FROM documents
                  UNION ALL SELECT FALSE, item_id, text FROM benchmark),
        words AS (
          SELECT doc, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
        feats AS (
          SELECT doc, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
          FROM words WHERE len(w) > 0),
        counted AS (SELECT doc, id, f, count(*) AS n FROM feats GROUP BY ALL),
        sums AS (
          SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(f))),
                                      lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
                                    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
          FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)), tab),
        placed AS (SELECT counted.*, bucket FROM counted JOIN sums USING (f)),
        totals AS (SELECT bucket, sum(n) FILTER (WHERE doc) AS s, sum(n) FILTER (WHERE NOT doc) AS t FROM placed GROUP BY bucket),
        whole AS (SELECT coalesce(sum(s), 0) + 10000.0::DOUBLE AS s, coalesce(sum(t), 0) + 10000.0::DOUBLE AS t FROM totals),
        gain AS (
          SELECT bucket, floor(1000 * ln((coalesce(totals.t, 0) + 1.0::DOUBLE) * whole.s
                                         / ((coalesce(totals.s, 0) + 1.0::DOUBLE) * whole.t))) AS g FROM totals, whole),
        weights AS (SELECT id, sum(n) AS n, floor(sum(n * g) / sum(n)) AS weight
                    FROM placed JOIN gain USING (bucket) WHERE doc GROUP BY id),
        scored AS (
          SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                 CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln(
                   (CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
          FROM documents LEFT JOIN weights ON weights.id = doc_id),
        ranks AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n
                    FROM scored WHERE n_features >= 39)
        SELECT scored.*, CAST(CASE WHEN r <= (25 * n) // 100 THEN r END AS BIGINT) AS rank
        FROM scored LEFT JOIN ranks USING (doc_id)""",
    "op12_ranked_search": r"""
        WITH d AS (
          SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
          FROM documents WHERE text IS NOT NULL),
        q AS (
          SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
          FROM benchmark WHERE text IS NOT NULL),
        n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
        t AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM n),
        m AS (SELECT doc_id, 100 - 25 + ((25 * n * docs) // words) AS m FROM n, t),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
              FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), t),
        s AS (
          SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
          FROM (SELECT item_id, term, count(*) AS times FROM q GROUP BY ALL) JOIN tf USING (term) JOIN w USING (term)
               JOIN m USING (doc_id)
          GROUP BY ALL),
        r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                     doc_id, score FROM s WHERE score > 0)
        SELECT * FROM r WHERE rank <= 20""",
}
