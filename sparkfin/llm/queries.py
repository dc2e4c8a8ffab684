"""Registered queries of the operators: each applies one operator, with its
production parameters, to its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfin.sources.tables import read_table

from . import (decontaminate, fill_middle, lang_id, licenses, mixing, near_dup, periodic, quality, simhash, substring_dedup, top_inner,
               toxicity, warc)
from .shared import run_folder


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (text, source as host) and pages (text, lang attribute,
    address) in one run: one text model, learnt from document labels."""
    docs, pages = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "pages")
    model = lang_id.fit(docs.select(F.col("lang").alias("label"), "text", F.lit(False).alias("markup")))
    none = F.lit(None).cast("long")
    evidence = ["doc_id", "page_id", "text", "markup", "declared", "suffix", "host", "domain"]
    rows = lang_id.document_evidence(docs.withColumn("page_id", none)).select(evidence).unionByName(
        lang_id.page_evidence(pages.withColumn("doc_id", none)).select(evidence))
    return lang_id.identify(rows, model)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, model).withColumnRenamed("id", "doc_id")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_folder(spark, "warc")
    warc.write_archive(read_table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_top_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner.top_inner(read_table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, dealt = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixing.taken(rows, dealt).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "shard_words")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents")) \
        .select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).withColumnRenamed("id", "doc_id")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(periodic.with_planted_runs(read_table(spark, sf_dir, "documents")), "id")
    best = F.col("best")
    return found.withColumn("best", periodic.strongest()).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(periodic.listing(), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_middle.fill_in_middle(read_table(spark, sf_dir, "documents"))
    return done.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2(fill_middle.restored(), 256).alias("restored_sha256"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_language_id, op2_quality, op3_decontaminate, op4_near_duplicates, op5_warc, op6_licenses, op7_top_inner,
    op8_mixing, op9_substring_dedup, op10_toxicity, op11_periodic_runs, op12_fill_in_middle, op13_simhash, pipeline)}

ORACLES: dict[str, str] = {"op5_warc": warc.ORACLE, "op7_top_inner": top_inner.ORACLE, "op8_mixing": mixing.ORACLE,
                           "op9_substring_dedup": substring_dedup.ORACLE, "op12_fill_in_middle": fill_middle.ORACLE}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
