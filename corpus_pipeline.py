"""Corpus pipeline: documents in, packed training sequences out.

Stages, each an operator of ``lendfeat.llm`` on all that its predecessor kept:

1. language ID: drops documents without a letter, or of which no learned language knows ``KNOWN``
   of the n-grams, and sets ``lang`` to the language found;
2. n-gram Jaccard join: of each group of near copies the smallest doc_id stays;
3. PII: personal data is replaced in the text, disclosing terms are generalised or removed;
4. mixing: a document appears as often as the mix takes it, to the nearest whole copy;
5. packing: a row per piece of a sequence, with its token ids.

ORACLE_SQL is None: tokenisation, language ID and the join on shingles aren't SQL.  Nulls, empty
texts, repeated rows, empty tables and extra columns (whatever their names) are handled as the operators
say.  Decisions are made and applied by row, not by id: rows that share an id or have none are rows of their
own, and only rows that are equal in every column are interchangeable.  run() deletes a stage's scratch tables
once its rows are written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendfeat.llm import jaccard_join, language_id, mixing, packing, pii, prepare
from lendfeat.llm._store import release, settle, written
from lendfeat.llm.queries import tokenizer_path

#: Least share of a text's n-grams that its language must know.
KNOWN = 0.1
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    columns = docs.columns
    judged = language_id.identify(docs.withColumnsRenamed({c: f"_in_{c}" for c in columns}), language_id.fit(docs), text="_in_text")
    kept = judged.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= KNOWN))
    return kept.select(*[F.col("lang_pred").alias(c) if c == "lang" else F.col(f"_in_{c}").alias(c) for c in columns])


def _fresh(name: str, columns: list[str]) -> str:
    while name in columns:
        name += "_"
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a row key: a hash of every column, so rows that share it are equal and interchangeable."""
    key = _fresh("__row_key", docs.columns)
    return docs.withColumn(key, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])), key


def _joined(keyed: DataFrame, key: str, decided: DataFrame, rows: str) -> DataFrame:
    """The documents that a narrow table of row keys names, with its columns; of equal rows (``rows`` > 1) one.

    The table grows with the documents and is never broadcast: texts move once, whatever the size."""
    kept = keyed.join(decided.hint("merge"), key)
    if not decided.where(F.col(rows) > 1).limit(1).count():
        return kept
    return kept.where(F.col(rows) == 1).unionByName(kept.where(F.col(rows) > 1).dropDuplicates([key]))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    keyed, key = _keyed(docs)
    rows, name = _fresh("__rows", docs.columns), F.col("doc_id")
    groups = jaccard_join.join(keyed.select(F.col(key).alias("doc_id"), "text"))
    of = groups.groupBy(F.col("doc_id").alias(key)).agg(F.min("class_id").alias("class"), F.count("*").alias(rows))
    ids = of.join(keyed.select(key, "doc_id").distinct(), key)
    # the smallest doc_id of each group stays, null last
    first = F.min(F.struct(name.isNull().alias("none"), name.alias("id"), F.col(key).alias("key"), F.col(rows).alias("rows"))).alias("first")
    stays = ids.groupBy("class").agg(first).select(F.col("first.key").alias(key), F.col("first.rows").alias(rows))
    return _joined(keyed, key, settle(stays, "stays"), rows).select(*docs.columns)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _, terms = pii.find(docs)
    clean = pii.sanitise(docs, terms)
    return (clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed, key = _keyed(docs)
    rows, copies = _fresh("__rows", docs.columns), _fresh("__copies", docs.columns)
    mixed, _ = mixing.mix(keyed.select(F.col(key).alias("doc_id"), "text", "source"))
    # equal rows are emitted by one of them, as often as the mix takes all of them
    whole = F.sum(F.floor(F.col("taken") / F.col("size") + 0.5)).cast("long")
    taken = mixed.where("size > 0").groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias(rows), whole.alias(copies))
    kept = _joined(keyed, key, settle(taken.where(F.col(copies) > 0), "copies"), rows)
    copy = _fresh("__copy", docs.columns)
    return kept.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(docs, tokenizer_path(), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_copies", drop_near_copies),
    ("pii", remove_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = written(spark)
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(docs, before)  # the stage's scratch and its input
    return docs
