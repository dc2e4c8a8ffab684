"""Language identification by Bayesian evidence fusion.

The posterior of a row's language multiplies four kinds of evidence:

* text: naive Bayes over hashed byte trigrams of the letters, fitted on a
  bounded sample of labelled rows.  Trigrams of a text depend on each other, so
  its log likelihood counts as at most ``EFFECTIVE`` independent trigrams;
* declared markup language and address suffix: P(value | language), estimated
  on all rows from the text posteriors by grouped aggregation;
* host: a prior per host, smoothed towards its domain's prior, which is
  smoothed towards the prior of all rows.  Counts are sums of text posteriors,
  and a row's own posterior is taken out of the counts it is judged by.

Hosts, domains, values and languages are grouped with map-side combining; a
host that holds a third of all rows is one combined row per task, and the join
back is a plain equi-join that adaptive execution may split.

Defined results: missing evidence (null or empty) is left out; a row without a
letter gets the language the other evidence favours but is not accepted; with
no labelled rows every language is null and nothing is accepted; repeated rows
are each identified; an empty table gives an empty result; every column that
is not evidence is carried along under any name, but for lang, confidence and
accepted, which the result brings itself.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

BUCKETS = 1 << 16
#: labelled rows the text model is fitted on, at most
SAMPLE_ROWS = 4000
EFFECTIVE = 200
#: pseudo-rows a coarser prior counts for
STRENGTH = 5.0
ACCEPT = 0.5
#: prior of the background class
BACKGROUND = 0.01

_MARKUP = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-zA-Z#0-9]+;", re.S | re.I)
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def trigrams(text: str | None, markup: bool = False) -> np.ndarray:
    """Buckets of the byte trigrams of the lower-cased letters."""
    if not text:
        return np.empty(0, np.int64)
    if markup:
        text = _MARKUP.sub(" ", text)
    raw = b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split())
    if not raw:
        return np.empty(0, np.int64)
    b = np.frombuffer(b" " + raw + b" ", np.uint8).astype(np.uint32)
    g = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
    return ((g * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def _count(batches):
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for label, text, markup in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            c = counts.setdefault(label, np.zeros(BUCKETS, np.int64))
            c += np.bincount(trigrams(text, markup), minlength=BUCKETS)
    for label, c in counts.items():
        at = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array([label] * len(at)), pa.array(at), pa.array(c[at])], names=["label", "bucket", "n"])


def fit(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities [bucket, language]) from the labelled
    texts (label, text, markup) with the smallest hashes; copies of a text count
    once.  What reaches the driver is the table of counts, at most buckets x
    languages of the sample."""
    key = ["hash", "label", "markup"]
    known = rows.filter("label is not null and text is not null").select("label", "text", "markup", F.xxhash64("text").alias("hash"))
    chosen = known.select(key).distinct().orderBy(key).limit(sample_rows)
    sample = known.join(chosen, key).groupBy(key).agg(F.first("text").alias("text"))
    got = sample.select("label", "text", "markup").mapInArrow(_count, "label string, bucket long, n long") \
        .groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(got["label"].unique())
    table = np.zeros((BUCKETS, len(names)))
    table[got["bucket"], got["label"].map({x: i for i, x in enumerate(names)}).astype(int)] = got["n"]
    p = (table + 0.1) / (table + 0.1).sum(axis=0)
    return names, np.log(p).astype(np.float32)


def _score(model: np.ndarray):
    def run(batches):
        width = model.shape[1]
        for batch in batches:
            n, scores = [], []
            for text, markup in zip(batch.column("text"), batch.column("markup"), strict=True):
                g = trigrams(text.as_py(), markup.as_py())
                total = np.zeros(width)
                for i in range(0, len(g), 1 << 16):
                    total += model[g[i:i + (1 << 16)]].sum(axis=0, dtype=np.float64)
                n.append(len(g))
                scores.append((total * min(1.0, EFFECTIVE / max(1, len(g)))).tolist())
            keep = [x for x in batch.schema.names if x not in ("text", "markup")]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in keep), pa.array(n, pa.int64()), pa.array(scores, pa.list_(pa.float64()))],
                                             names=[*keep, "n", "ll"])
    return run


def _softmax(col) -> F.Column:
    e = F.transform(col, lambda x: F.exp(x - F.array_max(col)))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def _given(rows: DataFrame, column: str, width: int) -> DataFrame:
    """log P(value | language) of each value of ``column``, one row per value."""
    c = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(*(F.sum(F.col("post")[i]).alias(f"c{i}") for i in range(width)))
    values = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    logs = [F.log((F.col(f"c{i}") + 1 / values) / (F.sum(f"c{i}").over(Window.partitionBy(F.lit(0))) + 1)) for i in range(width)]
    return c.select(column, F.array(*logs).alias(f"log_{column}"))


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray], strength: float = STRENGTH) -> DataFrame:
    """``rows``: carried columns and text, markup (boolean), declared, suffix, host,
    domain.  Returns the carried columns, lang, confidence and accepted."""
    names, table = model
    evidence = ("text", "markup", "declared", "suffix", "host", "domain")
    ids = [c for c in rows.columns if c not in (*evidence, "lang", "confidence", "accepted")]
    if not names:
        return rows.select(*ids, F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"), F.lit(False).alias("accepted"))
    width = len(names)
    # the carried columns travel as one, so none meets a column of this module
    rows = rows.select(F.struct(*(F.col(f"`{c}`") for c in ids), *([] if ids else [F.lit(0).alias("none")])).alias("row"), *evidence)
    schema = f"row {rows.schema['row'].dataType.simpleString()}, declared string, suffix string, host string, domain string, n long, ll array<double>"
    e = written(rows.select("row", "declared", "suffix", "host", "domain", "text", "markup").mapInArrow(_score(table), schema).withColumn("post", _softmax(F.col("ll"))), "lang-evidence")

    sums = [F.sum(F.col("post")[i]).alias(f"s{i}") for i in range(width)]
    everything = e.agg(F.count(F.lit(1)).alias("all_n"), *sums).select("all_n", F.array(*(F.col(f"s{i}") for i in range(width))).alias("all_c")).first()
    if not everything.all_n:
        return e.select(*(f"row.`{c}`" for c in ids), F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"), F.lit(False).alias("accepted"))
    base = F.array(*(F.lit((c + 1.0) / (everything.all_n + width)) for c in everything.all_c))
    for level in ("domain", "host"):
        t = e.filter(F.col(level).isNotNull()).groupBy(level).agg(F.count(F.lit(1)).alias(f"{level}_n"), *sums) \
            .select(level, f"{level}_n", F.array(*(F.col(f"s{i}") for i in range(width))).alias(f"{level}_c"))
        e = e.join(t, level, "left")
    for column in ("declared", "suffix"):
        e = e.join(_given(e, column, width), column, "left")

    prior = base
    for level in ("domain", "host"):
        others = F.greatest(F.col(f"{level}_n") - 1, F.lit(0))
        counts = F.zip_with(f"{level}_c", "post", lambda c, p: F.greatest(c - p, F.lit(0.0)))
        smooth = F.zip_with(counts, prior, lambda c, b: (c + strength * b) / (others + strength))  # noqa: B023
        prior = F.when(F.col(f"{level}_n").isNull(), prior).otherwise(smooth)
        e = e.withColumn(f"{level}_prior", prior)
        prior = F.col(f"{level}_prior")
    total = F.zip_with("ll", prior, lambda a, b: a + F.log(b))
    for column in ("declared", "suffix"):
        total = F.when(F.col(f"log_{column}").isNull(), total).otherwise(F.zip_with(total, F.col(f"log_{column}"), lambda a, b: a + b))
    even = F.log(F.lit(BACKGROUND)) - F.least(F.col("n"), F.lit(EFFECTIVE)) * F.log(F.lit(float(BUCKETS)))
    for column in ("declared", "suffix"):  # a value tells nothing about the background
        mean = F.aggregate(f"log_{column}", F.lit(0.0), lambda a, b: a + F.exp(b) / width)
        even = F.when(F.col(f"log_{column}").isNull(), even).otherwise(even + F.log(mean))
    e = e.withColumn("fused", total).withColumn("final", _softmax(F.col("fused"))).withColumn("even", even)
    top = F.array_max("final")
    held = 1 / (1 / top + F.exp(F.col("even") - F.array_max("fused")))
    return e.select(*(f"row.`{c}`" for c in ids), F.element_at(F.array(*map(F.lit, names)), F.array_position("final", top).cast("int")).alias("lang"),
                    top.alias("confidence"), ((F.col("n") > 0) & (held >= ACCEPT)).alias("accepted"))


def document_evidence(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Evidence of plain documents: the text, and the source as host."""
    none = F.lit(None).cast("string")
    return docs.withColumns({"text": F.col(text_col).cast("string"), "markup": F.lit(False), "declared": none, "suffix": none,
                             "host": F.col(host_col).cast("string"), "domain": none})


def page_evidence(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """Evidence of web pages: the text between tags, the lang attribute of the
    html tag, the last label of the host, the host and its last two labels."""
    host = F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    declared = F.lower(F.regexp_extract(F.col(html_col), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1))
    blank = F.lit("")
    return pages.withColumns({
        "text": F.col(html_col).cast("string"), "markup": F.lit(True), "declared": F.nullif(declared, blank),
        "suffix": F.nullif(F.regexp_extract(host, r"\.([a-z]{2,})$", 1), blank), "host": F.nullif(host, blank),
        "domain": F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), blank)})
