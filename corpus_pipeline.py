"""Corpus pipeline: language, near-duplicates, benchmark passages, personal data, mixture.

Every stage takes (spark, docs, sf_dir) and works on all documents its
predecessor kept; ``run`` writes each result as Parquet to the shared folder
and reads it again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, lang_id, mixture, pii, simhash_dedup
from quarry.llm.common import materialise
from quarry.sources.tables import load_table

MIN_LANGUAGE_SCORE = 0.5
#: Learned and cut by rules that other stages don't see; SQL can't state them. Brute-force versions are in the tests.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose words are mostly of one learned language; goes: und, or a score below one half."""
    usable = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    model = lang_id.train(lang_id.training_sample(docs, usable))
    kept = lang_id.predict(docs, model).filter(
        (F.col("lang_pred") != lang_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each SimHash component (3-word
    shingles, 2 bits); repeated rows of it count once. A document without an id
    stays only if its component has no named one, and then one of them does."""
    row = max(docs.columns, key=len) + "_row"   # clashes with no column
    numbered = docs.withColumn(row, F.col("doc_id"))
    if not docs.filter("doc_id is null").isEmpty():
        # numbers after all ids, and written once, so that every reader sees the same ones
        last = docs.agg(F.coalesce(F.max("doc_id"), F.lit(0)).cast("long")).first()[0]
        own = docs.filter("doc_id is null").withColumn(row, F.monotonically_increasing_id() + F.lit(last + 1))
        numbered = numbered.filter("doc_id is not null").unionByName(materialise(own, "unnamed"))
    found = simhash_dedup.near_duplicates(numbered, id_col=row, shingle=3, max_bits=2)
    kept = found.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(row)).distinct()
    once = numbered.join(kept, row, "left_semi")
    if _repeats(kept.withColumnRenamed(row, "doc_id"), found):
        once = once.dropDuplicates([row])
    return once.select(*docs.columns)


def _repeats(kept: DataFrame, found: DataFrame) -> bool:
    """Whether a kept id has several rows; only then are texts shuffled by id."""
    return not found.join(kept, "doc_id", "left_semi").groupBy("doc_id").count().filter("count > 1").isEmpty()


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a 10-word window of a benchmark item."""
    hits = decontaminate.benchmark_hits(docs, load_table(spark, sf_dir, "benchmark"), window=10)
    return hits.filter(~F.col("contaminated")).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets; n_chars follows. Null texts stay null."""
    found = pii.personal_data(docs, pii.train(pii.training_sample(docs)))
    text = F.when(F.col("text").isNotNull(), F.col("masked"))
    return found.select(*[text.alias(c) if c == "text" else F.length(text).cast(docs.schema[c].dataType).alias(c)
                          if c == "n_chars" else F.col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy that the mix takes: the columns of documents, and copy (from 1)."""
    taken = mixture.mix(docs).filter("copies > 0").groupBy("doc_id", "source", "unit").agg(F.max("copies").alias("copies"))
    taken = materialise(taken.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"),
                                     F.col("unit").alias("_unit"), "copies"), "taken")
    keyed = docs.withColumn("unit", F.xxhash64("text", "doc_id"))
    keyed = mixture.own_units(keyed, ["unit", "doc_id", "source"])
    both = keyed.join(taken, (F.col("unit") == F.col("_unit")) & F.col("doc_id").eqNullSafe(F.col("_id"))
                      & F.col("source").eqNullSafe(F.col("_source")))
    return both.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmark_passages", benchmark_passages),
          ("personal_data", personal_data), ("mix_sources", mix_sources)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``."""
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
