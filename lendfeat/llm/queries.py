"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendfeat.llm import ann_blocks, importance_resampling, jaccard_join, language_id, lexical_search, license_scan, mixing, packing, pii, piece_agenda, prepare, sharding, topk_uniform, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_fold(4) == 2, F.lit(False))
    model = language_id.fit(docs.where(~held_out))
    return language_id.identify(docs.withColumn("held_out", held_out), model).select("doc_id", "held_out", "lang_pred", "score", "margin")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_fold(5) == 0, F.lit(False))
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out)
    model = toxicity.fit(toxicity.labelled(docs, labels))
    return toxicity.score(docs.withColumn("held_out", held_out), model).select("doc_id", "held_out", "score", "predicted", "whole", "expression")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_blocks.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(_table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("home").alias("home_shard"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = mixing.mix(_table(spark, sf_dir, "documents"))
    return documents.select("doc_id", "size", "source_size", "target", "taken")


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_uniform.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = pii.find(_table(spark, sf_dir, "documents"))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return rows.select("doc_id", *counts, F.sha2(pii.listed(list(pii.KINDS)), 256).alias("base_sha256"), pii.listed([*pii.KINDS, "term"]).alias("spans"))


def piece_model_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op11_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_agenda.encode(_table(spark, sf_dir, "documents"), piece_model_path())


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_language_id, op2_jaccard_join, op3_toxicity, op4_license_scan, op5_nearest_neighbours, op6_sharding, op7_mixing, op8_exact_topk, op9_packing, op10_pii, op11_piece_agenda, op12_lexical_search, op13_importance_resampling, pipeline)

    def ready(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        return run

    return {fn.__name__: ready(fn) for fn in every}


def _topk_sql(queries: str, k: int, vector: str, kind: str, product: str, extra: str) -> str:
    return f"""
WITH used AS (
  SELECT vec_id, {vector} AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0 {extra}
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST({product} AS {kind}) AS score
  FROM used q JOIN used c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE {queries}
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {k}"""


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LEXICAL_SQL = rf"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL
), docs AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM split WHERE len(w) > 0
), sums AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_all FROM docs
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), freq AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS term FROM docs) GROUP BY r, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM freq, sums GROUP BY term
), scored AS (
  SELECT a.item_id, f.r, d.doc_id, CAST(sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 8 * (10 + (90 * d.n * s.n_docs) // s.n_all)))) AS BIGINT) AS score
  FROM asked a JOIN freq f USING (term) JOIN weights w USING (term) JOIN docs d ON d.r = f.r CROSS JOIN sums s
  GROUP BY a.item_id, f.r, d.doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""

# the CRC-32 of each distinct feature, byte by byte over its table
_RESAMPLING_SQL = rf"""
WITH crc AS (
  SELECT list(list_reduce([i::BIGINT] || [0::BIGINT FOR x IN range(8)], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)
), split AS (
  SELECT 0 AS side, row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 1, row_number() OVER (), item_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), had AS (
  SELECT side, r, unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS f FROM split
), counted AS (SELECT side, r, f, count(*) AS n FROM had GROUP BY side, r, f
), distinct_features AS (SELECT DISTINCT f FROM counted
), hashed AS (
  SELECT f, xor(list_reduce([4294967295::BIGINT] || [('0x' || substr(hex(encode(f)), (2 * i + 1)::BIGINT, 2))::BIGINT FOR i IN range(len(hex(encode(f))) // 2)],
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM distinct_features, crc
), sums AS (
  SELECT bucket, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM counted JOIN hashed USING (f) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (sum(s) OVER () + 10000)::DOUBLE / ((coalesce(s, 0)::DOUBLE + 1) * (coalesce(sum(t) OVER (), 0) + 10000)::DOUBLE))) AS BIGINT) AS gain FROM sums
), means AS (
  SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS total FROM counted JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 0 GROUP BY r
), scored AS (
  SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_features, 0) AS n_features,
    coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
    CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS noise
  FROM split d LEFT JOIN means m ON d.r = m.r WHERE d.side = 0
), ranked AS (
  SELECT *, weight + noise AS score, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY weight + noise DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS able FROM scored
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN n_words >= 20 AND place <= 25 * able // 100 THEN CAST(place AS BIGINT) END AS rank FROM ranked"""


def oracle_sql() -> dict[str, str]:
    # plain sums in component order, as the operators add them
    whole = "[floor(256 * x::DOUBLE) FOR x IN embedding]"
    return {
        "op5_nearest_neighbours": _topk_sql("q.vec_id % 20 = 0", 20, "embedding::DOUBLE[]", "DOUBLE", "list_inner_product(q.v, c.v)", "AND len([x FOR x IN embedding IF x <> 0]) > 0"),
        "op8_exact_topk": _topk_sql("q.vec_id % 50 = 0", 5, whole, "BIGINT", "list_inner_product(q.v, c.v)", ""),
        "op12_lexical_search": _LEXICAL_SQL,
        "op13_importance_resampling": _RESAMPLING_SQL,
    }
