"""The queries of this subpackage: thin functions (spark, sf_dir) -> DataFrame, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrolite.llm import decontaminate, divergence, jaccard, langid, langmodel, neardup, negatives, packing, quality, secrets, sharding, surrogates, topk
from ferrolite.llm.common import fold
from ferrolite.llm.tokens import vocabulary


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    judged = langid.identify(docs, langid.fit_dictionaries(docs, ~held_out))
    return judged.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("lang_best").alias("lang_pred"), "score", "margin", "rejected")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 3) == 1
    scored = quality.score(docs, quality.fit(docs, labels, ~held_out))
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "matched", "windows", "coverage", "exact")


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 7) == 2
    net, vocab, counts = langmodel.fit(docs, ~held_out)
    scored = langmodel.score(docs, net, vocab, counts)
    return scored.withColumn("held_out", F.coalesce(held_out, F.lit(False)))


def op5_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


#: The key of the query's surrogates; a user passes a secret one.
SURROGATE_KEY = b"op7"


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = surrogates.checked(_table(spark, sf_dir, "documents"), SURROGATE_KEY)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    counts = [count(k).alias(f"n_{k}") for k in surrogates.KINDS]
    joined = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", *counts, joined.alias("spans"), "text")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary())


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.fit(docs))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in secrets.KINDS], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_by_bytes(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_quality": op2_quality,
    "op3_decontamination": op3_decontamination,
    "op4_language_model": op4_language_model,
    "op5_maxscore_topk": op5_maxscore_topk,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_pii_surrogates": op7_pii_surrogates,
    "op8_packing": op8_packing,
    "op9_secret_scan": op9_secret_scan,
    "op10_sharding": op10_sharding,
    "op11_source_divergence": op11_source_divergence,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op5_maxscore_topk": """
        WITH v AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 50 = 0
        ),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op11_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ),
        t AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
        c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t GROUP BY ALL),
        kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 10),
        l AS (SELECT lang, sum(n)::HUGEINT AS total, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
        g AS (SELECT DISTINCT lang, source FROM d),
        cell AS (SELECT g.lang, g.source, kept.term, kept.n AS lang_n, coalesce(c.n, 0)::HUGEINT AS n FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
        total AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM cell GROUP BY ALL),
        dense AS (
            SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)) // (total.total + 2 * v) AS p, 1 + (1000000000 * (lang_n + 2)) // (l.total + 2 * v) AS q
            FROM cell JOIN total USING (lang, source) JOIN l USING (lang)
        ),
        pair AS (
            SELECT a.lang, a.source, b.source AS item,
                   coalesce((SELECT sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) FROM dense x JOIN dense y ON x.lang = y.lang AND x.term = y.term WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        ),
        term AS (SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM dense WHERE n > 0 AND p > q),
        ranked AS (
            SELECT *, 'pair' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pair
            UNION ALL
            SELECT *, 'term' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM term
        )
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
    """,
    "op13_hard_negatives": """
        WITH v AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, list_inner_product(a.v, c.v)::BIGINT AS score
            FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
            WHERE a.vec_id % 50 = 0
        ),
        positive AS (SELECT * FROM scored WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
               n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
        QUALIFY rank <= 3
    """,
}
