"""Toxicity classifier: a factorization machine over hashed terms.

A text's terms are its lower-cased words and their first four and five
letters (inflections of one insult share them), hashed into buckets; a bucket
counts once per text.  The machine scores

    w0 + sum w_i + sum over pairs <v_i, v_j>

so that two terms that are harmless alone, such as an insult word and the name
of a group, can weigh together what no sum of single weights gives.  It is
fitted on a bounded sample of labelled rows, on the buckets whose presence
tells the classes apart best (G statistic of grouped counts) and on those of
the pairs that tell it only together, with Spark's factorization machine.  The pair term costs one pass over a text's terms:
sum over factors of ((sum v)^2 - sum v^2) / 2.

Scoring maps documents one batch at a time.  The model is some thousand
numbers whatever the data's size.

Defined results: a null or empty text has no terms and scores by w0; null
labels and null ids are not learnt from; with only one class in the sample
all scores are that class's (1 or 0), with none 0.5; repeated rows are each
scored; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .quality import cut_quantile, sample_rows
from .shared import held_out, written

FIT_ROWS = 12_000
BUCKETS_LOG2 = 22
#: buckets the machine weighs, each seen in at least MIN_ROWS sample rows
TERMS = 1024
MIN_ROWS = 5
#: buckets whose pairs are screened, those that may come in by a pair, and the
#: gain in G (natural log, no factor 2) a pair must show beyond its parts
SCREENED = 1024
PAIRED = 256
PAIR_GAIN = 30.0
FACTORS = 4
THRESHOLD = 0.3

_WORD = re.compile(r"[^\W\d_]+")


def terms(text: str | None) -> set[str]:
    """Words and their beginnings; a beginning ends in ``*``."""
    if not text:
        return set()
    words = set(_WORD.findall(text.lower()))
    return words | {w[:4] + "*" for w in words if len(w) > 4} | {w[:5] + "*" for w in words if len(w) > 5}


def bucket(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) >> (32 - BUCKETS_LOG2)


def _counted(batches):
    counts: dict[int, list[int]] = {}
    for batch in batches:
        for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            for b in {bucket(t) for t in terms(text.as_py())}:
                counts.setdefault(b, [0, 0])[y] += 1
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), *(pa.array([v[i] for v in counts.values()], pa.int64()) for i in (0, 1))],
                                     names=["bucket", "n0", "n1"])


def bucket_counts(sample: DataFrame) -> DataFrame:
    """(bucket, n0, n1) of the buckets seen in at least MIN_ROWS rows."""
    return sample.select("text", "y").mapInArrow(_counted, "bucket long, n0 long, n1 long") \
        .groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).filter(F.col("n0") + F.col("n1") >= MIN_ROWS)


def chosen_buckets(counts: DataFrame, r0: int, r1: int, size: int = TERMS) -> list[int]:
    """Buckets with the largest G statistic against the label."""
    total = r0 + r1

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    n = F.col("n0") + F.col("n1")
    g = sum((part(F.col(f"n{i}"), n * r / total) + part(F.lit(r) - F.col(f"n{i}"), (total - n) * F.lit(r) / total)
             for i, r in enumerate((r0, r1))), F.lit(0.0))
    top = counts.orderBy(g.desc(), "bucket").limit(size).select("bucket").collect()
    return sorted(r.bucket for r in top)


def pair_gains(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """What the presence of two columns of ``x`` together tells of ``y`` beyond
    what each tells alone: G of the four joint cells less both single G."""
    rows = [float((y == c).sum()) for c in (0, 1)]
    both = [x[y == c].T @ x[y == c] for c in (0, 1)]
    one = [np.diag(b).astype(np.float64) for b in both]

    def g(cells):
        seen = cells[0] + cells[1]
        out = np.zeros(seen.shape)
        for cell, r in zip(cells, rows, strict=True):
            with np.errstate(divide="ignore", invalid="ignore"):
                out += np.where(cell > 0, cell * np.log(cell * sum(rows) / (seen * r)), 0.0)
        return out

    alone = g(one) + g([r - o for r, o in zip(rows, one, strict=True)])
    joint = g(both)
    for left in (True, False):  # exactly one of the two
        joint += g([(o[:, None] if left else o[None, :]) - b for o, b in zip(one, both, strict=True)])
    joint += g([r - o[:, None] - o[None, :] + b for r, o, b in zip(rows, one, both, strict=True)])
    gain = joint - alone[:, None] - alone[None, :]
    np.fill_diagonal(gain, 0.0)
    return gain


def paired_buckets(sample: DataFrame, counts: DataFrame, total: int) -> list[int]:
    """Buckets of the pairs that tell the classes apart only together: all
    pairs of the SCREENED most balanced buckets are looked at, in one task over
    the bounded sample's places."""
    n = F.col("n0") + F.col("n1")
    even = [r.bucket for r in counts.orderBy(F.desc(n * (total - n)), "bucket").limit(SCREENED).select("bucket").collect()]
    finder = Machine(even)

    def screen(batches):
        labels, places = [], []
        for batch in batches:
            labels += batch.column(0).to_pylist()
            places += [np.asarray(a, np.int64) for a in batch.column(1).to_pylist()]
        x = np.zeros((len(labels), len(even)), np.float32)
        for i, at in enumerate(places):
            x[i, at] = 1
        gain = pair_gains(x, np.asarray(labels, np.int64)).max(axis=1, initial=0.0)
        good = np.argsort(-gain, kind="stable")[:PAIRED]
        good = good[gain[good] >= PAIR_GAIN]
        yield pa.RecordBatch.from_arrays([pa.array(np.asarray(even, np.int64)[good])], names=["bucket"])

    at = sample.mapInArrow(_places(finder), "label double, at array<long>")
    return sorted(r.bucket for r in at.repartition(1).mapInArrow(screen, "bucket long").collect())


def _places(finder: Machine):
    def run(batches):
        for batch in batches:
            got = [finder.indices(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.float64()), pa.array(got, pa.list_(pa.int64()))], names=["label", "at"])
    return run


class Machine:
    """Scores in 0..1; those of at least 0.3 are predicted toxic."""

    def __init__(self, buckets=(), w0=0.0, w=None, v=None, cut=0.0, constant=None):
        self.at = {b: i for i, b in enumerate(buckets)}
        self.w0, self.w, self.v, self.cut, self.constant = w0, w, v, cut, constant
        self.known: dict[str, tuple[int, ...]] = {}

    def _of_word(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            own = (self.at.get(bucket(t)) for t in terms(word))
            found = tuple(i for i in own if i is not None)
            if len(self.known) >= 200_000:  # only a memory of what was looked up
                self.known.clear()
            self.known[word] = found
        return found

    def indices(self, text: str | None) -> list[int]:
        """Places of a text's weighed buckets."""
        if not text:
            return []
        out: set[int] = set()
        for word in set(_WORD.findall(text.lower())):
            out.update(self._of_word(word))
        return sorted(out)

    def raw(self, at: list[int]) -> float:
        v = self.v[at]
        return self.w0 + float(self.w[at].sum()) + 0.5 * float((v.sum(axis=0) ** 2 - (v ** 2).sum(axis=0)).sum())

    def score(self, text: str | None) -> float:
        if self.constant is not None:
            return self.constant
        s = self.raw(self.indices(text)) - self.cut + math.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, s))))


def fit(docs: DataFrame, labels: DataFrame, bound: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic") -> Machine:
    sample = sample_rows(docs, labels, label, bound, id_col, text_col)
    sample = written(sample, "toxic-sample")
    seen = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    if len(seen) < 2:
        return Machine(constant=float(next(iter(seen))) if seen else 0.5)
    counts = written(bucket_counts(sample), "toxic-counts")
    buckets = sorted({*chosen_buckets(counts, seen[0], seen[1]), *paired_buckets(sample, counts, seen[0] + seen[1])})
    if not buckets:
        return Machine(constant=seen[1] / (seen[0] + seen[1]))
    rows = sample.mapInArrow(_places(Machine(buckets)), "label double, at array<long>").toPandas()  # the bounded sample's bucket places
    rows["key"] = rows["at"].map(lambda a: tuple(a))
    rows = rows.sort_values(["key", "label"])
    width = len(buckets)
    schema = StructType([StructField("label", DoubleType()), StructField("features", VectorUDT())])
    frame = docs.sparkSession.createDataFrame(
        [(y, SparseVector(width, [(int(i), 1.0) for i in a])) for y, a in zip(rows["label"], rows["at"], strict=True)], schema).coalesce(1).cache()
    model = FMClassifier(factorSize=FACTORS, maxIter=150, stepSize=0.1, regParam=1e-4, initStd=0.02, seed=10, solver="adamW", tol=1e-7).fit(frame)
    frame.unpersist()
    m = Machine(buckets, model.intercept, model.linear.toArray(), model.factors.toArray())
    raw = np.array([m.raw(list(a)) for a in rows["at"]])
    m.cut = cut_quantile(raw, rows["label"].to_numpy())
    return m


def score(docs: DataFrame, model: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: id, held_out, score, predicted."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            s = [model.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], names=["id", "score"])

    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, score double")
    return out.select("id", held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
