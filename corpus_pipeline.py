"""Corpus pipeline: language ID, near-duplicate removal, removal of repeated
passages, benchmark decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes every stage as
Parquet in the shared checkpoint folder and hands the next one what was
written, so a lost executor repeats at most one stage's tasks.

Defined results: a null id or text is handled as each operator states; a row
repeated exactly is one document to the filters (it stays or goes with its
copies of the same id); an empty table gives an empty mix.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfin.llm import decontaminate, lang_id, mixing, near_dup, substring_dedup
from sparkfin.llm.shared import written
from sparkfin.sources.tables import read_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: words of a shingle of the near-duplicate stage
SHINGLE = 5


def _decided(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """``docs`` whose id is in ``decisions`` (doc_id, once each); null ids match
    each other."""
    d = decisions.select(F.col("doc_id").alias("__id"))
    return docs.join(d, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is identified; sets ``lang``.  The text
    model learns from a bounded sample of the rows' language labels."""
    rows = docs.select(*COLUMNS)
    evidence = lang_id.document_evidence(rows.select("doc_id", "text", "source", F.xxhash64("text").alias("tag")))
    model = lang_id.fit(rows.select(F.col("lang").alias("label"), "text", F.lit(False).alias("markup")))
    found = lang_id.identify(evidence.drop("source"), model).filter("accepted").groupBy("doc_id", "tag").agg(F.first("lang").alias("found"))
    found = found.withColumnsRenamed({"doc_id": "__id", "tag": "__tag"})
    keyed = rows.withColumn("__t", F.xxhash64("text"))
    return keyed.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__t") == F.col("__tag"))) \
        .select("doc_id", "text", F.col("found").alias("lang"), "source", "n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate group."""
    kept = near_dup.near_duplicates(docs, shingle=SHINGLE).filter("kept").select(F.col("id").alias("doc_id")).distinct()
    return _decided(docs.select(*COLUMNS), kept)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes the words of repeated 20-word windows; the first occurrence
    stays.  Documents that lose nothing keep their text byte for byte."""
    out = substring_dedup.substring_dedup(docs, carry=("doc_id", "lang", "source", "n_chars"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return out.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item within its edit budget; a row
    of the same id (or without id, too) with another text stays."""
    rows = docs.select(*COLUMNS)
    keyed = rows.withColumn("__t", F.xxhash64("text"))
    asked = keyed.select(F.struct(F.col("doc_id").alias("__id"), F.col("__t").alias("__tag")).alias("__key"), "text")
    bad = decontaminate.leaks(asked, read_table(spark, sf_dir, "benchmark"), id_col="__key").select("id.*").distinct()
    return keyed.join(bad, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__t") == F.col("__tag")), "left_anti").select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: per document its size, its source's size and target, and the
    words the mix takes."""
    rows, dealt = mixing.mix(docs)
    return mixing.taken(rows, dealt).select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken")


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
]

#: the stages use fitted models and hashing that SQL cannot state; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each read from what the one before wrote."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
