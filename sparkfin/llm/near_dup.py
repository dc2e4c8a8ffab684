"""Near duplicates: one-permutation MinHash, banded buckets, star edges.

A document's set holds its distinct word shingles as 64-bit hashes.  The hash
space is cut into bins; a set's signature is the smallest hash of each bin,
and an empty bin copies an occupied one found by a fixed probe sequence that
depends on the bin alone (optimal densification), so two sets agree in a bin
with the probability of their similarity.  Bands of the signature are bucket
keys.  Documents with equal sets are one class and travel as one row.

Candidates are star edges: each bucket names one center and pairs it with its
other members, so a bucket of n classes gives n - 1 pairs, never n * n.  Every
candidate is confirmed on the full sets.  The center is the member that shares
most buckets with others (in a group of variants that is the common original).

The finish is exact within buckets.  A bucket whose members are one component is
settled; in one that is not, members of different components meet in an
equi-join on the bucket, whose condition holds a safe bound: each set's parity
bitmap has a bit for the parity of the shingles that fall on it, and two
bitmaps differ in no more bits than their sets in shingles.  So of a family
that shares boilerplate but is not near, no pair leaves the join; rows are made
only for pairs at the similarity, or close to it.  The members of a bucket's
largest component need not meet each other, so one side goes without them.
A near pair is missed only if it shares no band at all.

Both joins may have hot buckets; they are plain equi-joins between written
tables, which adaptive execution splits.

Defined results: a null text has no words; a set without shingles, and a row
without id, is linked with nothing; an id repeated with other texts is one
document (its texts are linked); repeated rows come back as often as they
came; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import byte_words, gram_hashes, mixed, odd_constants, release, word_hashes, written

BANDS = 32
ROWS = 4
BINS_LOG2 = 7
PROBES = 256
SEED = 4
#: numerator and denominator of the least similarity
SIMILAR = (80, 100)
#: bits of a parity bitmap
BITS = 2048


def shingle_set(text: str | None, k: int, c: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer than ``k`` words are one shingle."""
    words = [w.lower() for w in byte_words(text)]  # bytes.lower() changes A-Z only
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    return np.unique(gram_hashes(h, c[:min(k, len(words))]))


def probe_table(bins: int = 1 << BINS_LOG2, probes: int = PROBES) -> np.ndarray:
    """Row i: the bins an empty bin i asks in turn; then every bin from i on."""
    i, t = np.meshgrid(np.arange(bins, dtype=np.uint64), np.arange(1, probes + 1, dtype=np.uint64), indexing="ij")
    asked = mixed(i * np.uint64(0x9E3779B97F4A7C15) + t * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - BINS_LOG2)
    round_trip = (np.arange(bins)[:, None] + np.arange(1, bins)[None, :]) % bins
    return np.concatenate([asked.astype(np.int64), round_trip], axis=1)


def signature(s: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Densified one-permutation signature of a sorted, non-empty set."""
    bins = len(table)
    edges = np.arange(bins, dtype=np.uint64) << np.uint64(64 - BINS_LOG2)
    start = np.searchsorted(s, edges)
    used = np.diff(np.append(start, len(s))) > 0
    donor = np.arange(bins)
    empty = np.flatnonzero(~used)
    if len(empty):
        asked = table[empty]
        donor[empty] = asked[np.arange(len(empty)), used[asked].argmax(axis=1)]
    return s[start[donor]]


def band_keys(sig: np.ndarray, c: np.ndarray) -> np.ndarray:
    """One hash per band of ``ROWS`` bins; the band's number is part of it."""
    b = sig.reshape(BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64) * c[ROWS]
    for j in range(ROWS):
        out = mixed(out + b[:, j]) * c[j]
    return mixed(out)


def _describe(k: int):
    def run(batches):
        c, table = odd_constants(max(k, ROWS + 1), SEED), probe_table()
        for batch in batches:
            n, digests, bands = [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), k, c)
                n.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(band_keys(signature(s, table), c).view(np.int64) if len(s) else np.empty(0, np.int64))
            ends = np.cumsum([0] + [len(b) for b in bands], dtype=np.int32)
            flat = np.concatenate(bands) if bands else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(ends, flat)],
                names=["id", "n", "digest", "bands"])
    return run


def parity_bits(s: np.ndarray) -> np.ndarray:
    """Bitmap, as longs, of the parity of the shingles on each bit."""
    odd = np.bincount((s & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _expand(k: int):
    def run(batches):
        c = odd_constants(max(k, ROWS + 1), SEED)
        for batch in batches:
            sets = [shingle_set(t.as_py(), k, c) for t in batch.column(1)]
            ends = np.cumsum([0] + [len(s) for s in sets], dtype=np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
            bits = np.concatenate([parity_bits(s) for s in sets]) if sets else np.empty(0, np.int64)
            at = np.arange(len(sets) + 1, dtype=np.int32) * (BITS // 64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, flat), pa.ListArray.from_arrays(at, bits)],
                                             names=["id", "grams", "bits"])
    return run


def confirmed(pairs: DataFrame, sets: DataFrame, similar=SIMILAR) -> DataFrame:
    """The rows of ``pairs`` (a, b, ..) whose full sets reach the similarity."""
    num, den = similar
    left = sets.select(F.col("id").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("id").alias("b"), F.col("grams").alias("gb"))
    both = F.size(F.array_intersect("ga", "gb"))
    j = pairs.join(right, "b").join(left, "a").select(*pairs.columns, both.alias("both"), (F.size("ga") + F.size("gb")).alias("total"))
    return j.filter(F.col("both") * den >= (F.col("total") - F.col("both")) * num).select(*pairs.columns)


def _stars(members: DataFrame, order, similar=SIMILAR) -> DataFrame:
    """Star edges of buckets: ``members`` (key, node, n, root, ...); the center
    has the largest ``order``; only members of other components are paired."""
    center = members.groupBy("key").agg(F.max(F.struct(order.alias("o"), F.col("node").alias("c"), F.col("root").alias("r"),
                                                       F.col("n").alias("m"))).alias("x")).select("key", "x.*")
    num, den = similar
    e = members.join(center, "key").filter("root <> r") \
        .filter((F.least("n", "m") * den >= F.greatest("n", "m") * num))
    return e.select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).distinct()


def unsettled_pairs(live: DataFrame, sets: DataFrame, similar=SIMILAR) -> DataFrame:
    """Pairs (a, b) of different roots (ra, rb) that share a bucket and may
    reach the similarity; ``live``: key, node, n, root."""
    num, den = similar
    share = live.groupBy("key", "root").agg(F.count(F.lit(1)).alias("held"))
    leads = share.groupBy("key").agg(F.max(F.struct("held", "root")).alias("x"), F.count(F.lit(1)).alias("roots")) \
        .filter("roots > 1").select("key", F.col("x.root").alias("lead"))
    bits = sets.select(F.col("id").alias("node"), "bits")
    left = written(live.join(leads, "key").join(bits, "node").select("key", "node", "n", "root", "lead", "bits"), "near-open")
    right = written(left.filter("root <> lead").select("key", *(F.col(c).alias(f"{c}2") for c in ("node", "n", "root", "bits"))), "near-apart")
    # of sets with n + n2 shingles, a near pair differs in so many at most
    most = (F.col("n") + F.col("n2")) * (den - num) / F.lit(den + num)
    differ = F.aggregate(F.zip_with("bits", "bits2", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    e = left.join(right, "key").filter((F.col("root") != F.col("root2")) & ((F.col("root") == F.col("lead")) | (F.col("node") < F.col("node2")))
                                       & (F.least("n", "n2") * den >= F.greatest("n", "n2") * num) & (differ <= most))
    low = F.col("node") < F.col("node2")
    return e.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b"),
                    F.when(low, F.col("root")).otherwise(F.col("root2")).alias("ra"),
                    F.when(low, F.col("root2")).otherwise(F.col("root")).alias("rb")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 2,
                    similar=SIMILAR) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id its
    links reach), kept (it is that document)."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    facts = written(src.mapInArrow(_describe(shingle), f"id {id_type}, n long, digest binary, bands array<long>"), "near-facts")
    classes = written(facts.filter("n > 0 and id is not null").groupBy("digest")
                      .agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands")), "near-classes")

    slots = classes.select("node", "n", F.posexplode("bands").alias("at", "key")).select("node", "n", "key")
    shared = slots.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = written(slots.join(shared, "key").withColumn("root", F.col("node")), "near-members")
    density = members.groupBy("node").agg(F.sum("size").alias("density"))
    ranked = members.join(density, "node")

    wanted = members.select(F.col("node").alias("id")).distinct()
    sets = written(src.join(wanted, "id", "left_semi").mapInArrow(_expand(shingle), f"id {id_type}, grams array<long>, bits array<long>"), "near-sets")

    tried = written(_stars(ranked, F.col("density"), similar), "near-tried")
    links = written(confirmed(tried, sets, similar), "near-links")
    roots = components(links, "near-roots")

    # the finish: members of unsettled buckets that are in different components
    found_root = roots.withColumnRenamed("root", "found")
    live = members.select("key", "node", "n").join(found_root, "node", "left").select("key", "node", "n", F.coalesce("found", "node").alias("root"))
    open_pairs = written(unsettled_pairs(written(live, "near-live"), sets, similar), "near-tried")
    found = written(confirmed(open_pairs, sets, similar), "near-links")
    release(members, sets)
    # roots are the smallest ids, so components of roots have the smallest ids too
    above = components(found.select(F.col("ra").alias("a"), F.col("rb").alias("b")), "near-above") \
        .select(F.col("node").alias("inner"), F.col("root").alias("top"))
    named = classes.select("digest", "node").join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("inner")) \
        .join(above, "inner", "left").select("digest", F.coalesce("top", "inner").alias("component"))
    out = facts.select("id", "n", "digest").join(named, "digest", "left")
    component = F.when(F.col("id").isNull() | (F.col("n") == 0), F.col("id")).otherwise(F.col("component"))
    return out.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
