"""Quality classifier by Bradley-Terry pairwise ranking.

A document has a strength w.x over features of its whole text.  Of a
preference pair the better document wins with probability
sigmoid(w.x_better - w.x_worse), so w is a logistic regression without
intercept on feature differences.  Pairs come from a bounded sample of
labelled rows: every better row meets a stated number of worse ones.  The
score that separates good from bad is a quantile of the sample's strengths,
the one that agrees best with the labels; the reported score is a logistic
curve through 0.7 there.

Features see characters, words and lines only.  Scoring maps documents one
batch at a time; nothing but the sample's ids and features leaves the tasks.

Defined results: a null or empty text has all features 0 and gets their score;
null labels and null ids are not learnt from; with only one class in the
sample all scores are that class's (1 or 0), with none 0.5; repeated rows are
each scored; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import held_out

#: labelled rows learnt from, at most, and worse rows each better row meets
FIT_ROWS = 12_000
RIVALS = 8
#: tasks that look at the sample's texts
SAMPLE_PARTS = 32
THRESHOLD = 0.7

FEATURES = ("log_words", "word_length", "upper", "digit", "blank", "exclaim", "bar", "sign", "stop", "other_ascii", "wide",
            "distinct", "commonest", "same_next", "same_second", "distinct_lines", "line_length", "tail_sign", "bare")


def features(text: str | None) -> list[float]:
    """Feature values of a whole text, in the order of ``FEATURES``."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    c = np.bincount(raw, minlength=256)
    size, n = len(raw), len(words)
    upper, lower, digit = c[65:91].sum(), c[97:123].sum(), c[48:58].sum()
    blank, wide = c[[9, 10, 11, 12, 13, 32]].sum(), c[128:].sum()
    exclaim, bar, sign, stop = c[33], c[124], c[[35, 36, 37, 38, 42, 64, 94, 126]].sum(), c[[44, 46]].sum()
    other = size - upper - lower - digit - blank - wide - exclaim - bar - sign - stop
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x]
    pairs = max(1, n - 1)
    return [
        math.log1p(n), min(size / n, 50.0) / 10, upper / max(1, upper + lower), digit / size, blank / size, exclaim / size, bar / size,
        sign / size, stop / size, other / size, wide / size,
        # distinct words fall with length; this ratio does not
        min(1.0, len(seen) / n ** 0.75), seen.most_common(1)[0][1] / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / pairs, sum(a == b for a, b in zip(words, words[2:], strict=False)) / pairs,
        len(set(lines)) / max(1, len(lines)), math.log1p(size / max(1, len(lines))),
        sum(not w[-1].isalnum() and w[-1] not in ".,;:?" for w in words) / n, sum(not any(map(str.isalpha, w)) for w in words) / n]


def _featured(batches):
    for batch in batches:
        x = [features(t.as_py()) for t in batch.column("text")]
        keep = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(x, pa.list_(pa.float64()))], names=[*keep, "x"])


def sample_rows(docs: DataFrame, labels: DataFrame, label: str, bound: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, y) of the labelled rows that may be learnt from, ``bound`` at
    most: those whose ids hash smallest, each text of an id once.  Ids and keys
    are that many, so they are broadcast."""
    ids = labels.select(F.col(id_col).alias("lid"), F.col(label).cast("int").alias("y")).filter("lid is not null and y in (0, 1)") \
        .filter(~held_out(F.col("lid"))).groupBy("lid").agg(F.max("y").alias("y")).orderBy(F.xxhash64("lid"), "lid").limit(bound)
    src = docs.select(F.col(id_col).alias("lid"), F.col(text_col).cast("string").alias("text"))
    known = src.join(F.broadcast(ids), "lid").withColumn("hash", F.xxhash64("text"))
    keys = known.select("lid", "hash").distinct().orderBy(F.xxhash64("lid"), "lid", "hash").limit(bound)
    return known.join(F.broadcast(keys), ["lid", "hash"]).dropDuplicates(["lid", "hash"]).repartition(SAMPLE_PARTS, "lid", "hash").select("text", "y")


def pair_indices(y: np.ndarray, rivals: int, seed: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Better and worse row of each preference pair."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    rng = np.random.default_rng(seed)
    return np.repeat(good, rivals), rng.choice(bad, size=len(good) * rivals)


def bradley_terry(x: np.ndarray, y: np.ndarray, rivals: int = RIVALS, ridge: float = 1e-3, rounds: int = 30) -> np.ndarray:
    """Weights that maximise the pairs' log likelihood with a small ridge, by
    Newton steps on feature differences."""
    better, worse = pair_indices(y, rivals)
    d = x[better] - x[worse]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        grad = d.T @ (1 - p) / len(d) - ridge * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / len(d) + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def cut_quantile(s: np.ndarray, y: np.ndarray) -> float:
    """The strength at the quantile that agrees with most labels; between two
    neighbouring strengths, in the middle of a run of equally good cuts."""
    order = np.argsort(s, kind="stable")
    s, y = s[order], y[order]
    right = np.concatenate([[0], np.cumsum(y == 0)]) + np.concatenate([[0], np.cumsum((y == 1)[::-1])])[::-1]
    best = np.flatnonzero(right == right.max())
    edges = np.concatenate([[s[0] - 1], (s[:-1] + s[1:]) / 2, [s[-1] + 1]])
    return float(edges[best[len(best) // 2]])


class Ranker:
    """Scores in 0..1; those of at least 0.7 are predicted good."""

    def __init__(self, mean, scale, w, cut, constant=None):
        self.mean, self.scale, self.w, self.cut, self.constant = mean, scale, w, cut, constant

    def score(self, x: list[float]) -> float:
        if self.constant is not None:
            return self.constant
        s = float((np.asarray(x) - self.mean) / self.scale @ self.w) - self.cut
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, s + math.log(THRESHOLD / (1 - THRESHOLD))))))


def fit(docs: DataFrame, labels: DataFrame, bound: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text", label: str = "quality") -> Ranker:
    got = sample_rows(docs, labels, label, bound, id_col, text_col).mapInArrow(_featured, "y int, x array<double>").toPandas()
    got["key"] = got["x"].map(lambda v: tuple(v))
    got = got.sort_values(["key", "y"])  # the same model however the sample's rows arrive
    y = got["y"].to_numpy()
    if len(set(y)) < 2:
        return Ranker(None, None, None, None, float(y[0]) if len(y) else 0.5)
    x = np.array(got["x"].tolist())
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.clip((x - mean) / scale, -20, 20)
    w = bradley_terry(z, y)
    return Ranker(mean, scale, w, cut_quantile(z @ w, y))


def score(docs: DataFrame, model: Ranker, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: id, held_out, score, predicted."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            s = [model.score(features(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], names=["id", "score"])

    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, score double")
    return out.select("id", held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
