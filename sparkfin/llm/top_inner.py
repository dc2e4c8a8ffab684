"""Exact top-k by inner product over norm-sorted blocks.

Vectors become integers floor(scale * x).  Candidates are sorted by length,
longest first, and packed in blocks.  The longest block gives every query a
first k-th best score.  Queries, packed in blocks too, then meet all candidate
blocks; inside a block candidates are taken longest first, and a run of them
is skipped when query length times their length cannot reach the query's k-th
best.  What is left is bounded in a rotated space: the rotation (the right
singular vectors of the candidates, from their d x d Gram matrix) gathers the
weight in the first coordinates, whose partial product plus the product of the
residual lengths (Cauchy-Schwarz) bounds the score.  Only candidates whose
bound reaches the k-th best get their integer score, so pruning never changes
a result.

The rotation and the longest block are of fixed size (d x d numbers and
``BLOCK`` vectors).  Blocks meet by an equi-join on the candidate block's
number; each pair returns at most k rows per query, and the final rank is per
query over k rows a block.

Defined results: rows without id and vectors that are null or hold null or
non-finite components take no part; shorter vectors count as padded with 0;
an id never meets itself; a repeated query row is answered again, a repeated
candidate row ranks again; equal scores go to the smaller id; with fewer than
k candidates all are returned; an empty table gives an empty result; other
columns are not read.  Products are exact up to 2**62.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

BLOCK = 4096
QUERY_BLOCK = 1024
#: candidates looked at together, and rotated coordinates of the partial sum
RUN = 512
HEAD = 16


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    fine = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    return rows.filter(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False))) \
        .select("id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))


def _matrix(column, d: int) -> np.ndarray:
    """Rows of a list column as an integer matrix, padded to ``d``."""
    flat, sizes = np.asarray(column.flatten()), np.diff(np.asarray(column.offsets))
    if len(sizes) and (sizes == d).all():
        return flat.reshape(-1, d)
    out = np.zeros((len(sizes), d), np.int64)
    out[np.arange(d)[None, :] < sizes[:, None]] = flat
    return out


def _gram(d: int):
    def run(batches):
        total = np.zeros((d, d))
        for batch in batches:
            m = _matrix(batch.column(0), d).astype(np.float64)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d * d)), pa.array(total.ravel())], names=["at", "x"])
    return run


def _pack(d: int, size: int):
    """Rows in order become blocks of ``size``: ids and the matrix as bytes, and
    the length of the longest row."""
    def run(batches):
        ids, rows, held = [], [], 0

        def emit(i, m):
            top = float(np.sqrt((m.astype(np.float64) ** 2).sum(axis=1).max()))
            return pa.RecordBatch.from_arrays([pa.array([i.tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary()), pa.array([top])], names=["ids", "m", "top"])
        for batch in batches:
            ids.append(np.asarray(batch.column(0)))
            rows.append(_matrix(batch.column(1), d))
            held += len(ids[-1])
            if held >= size:
                i, m = np.concatenate(ids), np.concatenate(rows)
                at = 0
                while held - at >= size:
                    yield emit(i[at:at + size], m[at:at + size])
                    at += size
                ids, rows, held = [i[at:]], [m[at:]], held - at
        if held:
            yield emit(np.concatenate(ids), np.concatenate(rows))
    return run


def _unpack(ids: bytes, m: bytes, d: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(m, np.int64).reshape(-1, d)


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.k, self.q, self.s, self.i = k, *(np.empty(0, np.int64) for _ in range(3))
        self.floor = np.full(n, -2.0**63) if floor is None else floor.copy()

    def add(self, q: np.ndarray, s: np.ndarray, i: np.ndarray) -> None:
        q, s, i = np.concatenate([self.q, q]), np.concatenate([self.s, s]), np.concatenate([self.i, i])
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        keep = nth < self.k
        self.q, self.s, self.i = q[keep], s[keep], i[keep]
        full = nth == self.k - 1
        self.floor[q[full]] = np.maximum(self.floor[q[full]], s[full].astype(np.float64))


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise integer products."""
    return np.einsum("ij,ij->i", a, b)


def search_block(best: Best, qid, qm, cid, cm, rotation: np.ndarray) -> None:
    """Let a block of candidates, longest first, meet the queries."""
    q, c = qm @ rotation, cm @ rotation
    h = min(HEAD, rotation.shape[1])
    qn, cn = np.sqrt((q ** 2).sum(1)), np.sqrt((c ** 2).sum(1))
    qr, cr = np.sqrt((q[:, h:] ** 2).sum(1)), np.sqrt((c[:, h:] ** 2).sum(1))
    slack = 1e-9 * (1 + qn.max(initial=0) * cn.max(initial=0))  # rounding of the bounds
    for a in range(0, len(cid), RUN):
        z = slice(a, a + RUN)
        live = np.flatnonzero(qn * cn[z].max() + slack >= best.floor)
        if not len(live):
            continue
        bound = q[live, :h] @ c[z, :h].T + qr[live, None] * cr[None, z] + slack
        x, y = np.nonzero(bound >= best.floor[live, None])
        x, y = live[x], y + a
        other = qid[x] != cid[y]
        x, y = x[other], y[other]
        for b in range(0, len(x), 1 << 17):
            xs, ys = x[b:b + (1 << 17)], y[b:b + (1 << 17)]
            s = exact_scores(qm[xs], cm[ys])
            good = s >= best.floor[xs]
            best.add(xs[good], s[good], cid[ys[good]])


def shortest(qm: np.ndarray, floor: np.ndarray) -> float:
    """The length a candidate needs, at least, to reach any query's floor."""
    length = np.sqrt((qm.astype(np.float64) ** 2).sum(axis=1))
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(floor > 0, floor / length * (1 - 1e-9), -np.inf)
    return float(need.min(initial=np.inf))


def block_pairs(asked: DataFrame, blocks: DataFrame) -> DataFrame:
    """(qblock, block) of the pairs that can hold a result, by the lengths
    alone: no vector is moved for a pair that is left out."""
    listed = blocks.agg(F.collect_list(F.struct("block", "top")).alias("listed")).withColumn("all", F.lit(0))
    pairs = asked.select("qblock", "need").withColumn("all", F.lit(0)).join(listed, "all")
    return pairs.select("qblock", F.explode(F.filter("listed", lambda b: b["top"] >= F.col("need"))).alias("b")).select("qblock", "b.block")


def top_inner(df: DataFrame, queries, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, scale: int = 256,
              block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of ``df`` for each
    row whose id meets ``queries`` (a function of the id column)."""
    spark = df.sparkSession
    ints = written(integer_vectors(df, id_col, vec_col, scale), "inner-vectors")
    n, d = ints.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not n or not d:
        return spark.createDataFrame([], schema)
    d = int(d)
    gram = ints.select("v").mapInArrow(_gram(d), "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).orderBy("at").toPandas()
    rotation = np.linalg.eigh(gram["x"].to_numpy().reshape(d, d))[1][:, ::-1].copy()

    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    parts = max(1, -(-n // block))
    sorted_rows = ints.withColumn("norm", norm).repartitionByRange(parts, F.desc("norm"), "id").sortWithinPartitions(F.desc("norm"), "id")
    numbered = F.monotonically_increasing_id().alias("block")
    blocks = written(sorted_rows.select("id", "v").mapInArrow(_pack(d, block), "ids binary, m binary, top double").select(numbered, "ids", "m", "top"), "inner-blocks")
    asked = ints.filter(queries(F.col("id"))).mapInArrow(_pack(d, query_block), "ids binary, m binary, top double")
    asked = written(asked.select(F.monotonically_increasing_id().alias("qblock"), "ids", "m"), "inner-queries")
    first = blocks.join(blocks.select("block").orderBy("block").limit(1), "block").first()
    head = bytes(first.ids), bytes(first.m)

    def opened(batches):
        cid, cm = _unpack(*head, d)
        for batch in batches:
            floors, needs = [], []
            for ids, m in zip(batch.column("ids"), batch.column("m"), strict=True):
                qid, qm = _unpack(ids.as_py(), m.as_py(), d)
                best = Best(len(qid), k)
                for a in range(0, len(qid), 64):
                    s = qm[a:a + 64] @ cm.T
                    s = np.where(qid[a:a + 64, None] == cid[None, :], -2**62, s)
                    top = np.argpartition(-s, min(k, s.shape[1]) - 1, axis=1)[:, :k]
                    x = np.repeat(np.arange(len(s)), top.shape[1])
                    y = top.ravel()
                    real = qid[a + x] != cid[y]
                    best.add((a + x)[real], s[x, y][real], cid[y[real]])
                floors.append(best.floor.tobytes())
                needs.append(shortest(qm, best.floor))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("qblock", "ids", "m")] + [pa.array(floors, pa.binary()), pa.array(needs, pa.float64())],
                                             names=["qblock", "ids", "m", "floors", "need"])

    def met(batches):
        for batch in batches:
            for row in batch.to_pylist():
                qid, qm = _unpack(row["qids"], row["qm"], d)
                cid, cm = _unpack(row["ids"], row["m"], d)
                best = Best(len(qid), k, np.frombuffer(row["floors"], np.float64))
                search_block(best, qid, qm, cid, cm, rotation)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best.q), row["qblock"])), pa.array(best.q), pa.array(qid[best.q]), pa.array(best.i), pa.array(best.s)],
                    names=["qblock", "q", "query_id", "vec_id", "score"])

    asked = written(asked.mapInArrow(opened, "qblock long, ids binary, m binary, floors binary, need double")
                    .withColumnsRenamed({"ids": "qids", "m": "qm"}), "inner-asked")
    met_blocks = block_pairs(asked, blocks)
    pairs = met_blocks.join(asked.drop("need"), "qblock")
    found = pairs.join(blocks.drop("top"), "block").select("qblock", "qids", "qm", "floors", "ids", "m") \
        .mapInArrow(met, "qblock long, q long, query_id long, vec_id long, score long")
    order = Window.partitionBy("qblock", "q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e from embeddings
           where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e::double[], c.e::double[])::bigint as score
      from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 5
"""
