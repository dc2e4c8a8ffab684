"""SimHash near duplicates: 64-bit fingerprints, pigeonring candidates.

A bit of a document's fingerprint is 1 if more than half of its shingles have
it set in their 64-bit hash.  Two fingerprints are linked at ``TAU`` differing
bits or fewer.  Equal fingerprints are one class and travel as one row.

The 64 bits are a ring of four segments with b_0..b_3 differing bits.  If they
sum to 3 at most, some segment i starts a chain that stays within its share of
the budget all the way: b_i <= 0, b_i + b_i+1 <= 1, b_i + b_i+1 + b_i+2 <= 2
(were there none, going round the ring from one failing chain to the next
would spend more than 3).  So the first two steps of the chain are a join
key: segment i as it is and segment i + 1 with one bit changed at most, 32
bits in all.  The third step is tested on the joined row, and only what is
left gets the full Hamming check.

A key with more than ``HOT`` classes is not paired.  Its fingerprints meet in
the middle instead: a class of the key stands at all places one bit away from
its other half, a fingerprint that probes the key looks at all places as far
away as its budget leaves.  Whoever looks at a place is linked with whoever
stands there, so one link to the smallest of them keeps the components, and
the work is a fixed number of rows a class however many share the key.

Defined results: a null or empty text, and one without words, has fingerprint
zero and is linked like any other; a row without id gets its fingerprint, no
component, and links nothing; an id repeated with other texts is one document
(its texts are linked); repeated rows come back as often as they came; an empty
table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import written

SHINGLE = 3
SEED = 42
TAU = 3
SEGMENTS, WIDTH = 4, 16
#: classes of a key above which they meet in the middle: about as many as the
#: places that a class then stands and looks at
HOT = 1024
#: shingles whose bits are counted at once
BLOCK = 1 << 16


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """Unsigned fingerprint of a whole text; bytes.lower() changes A-Z only."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    k = min(k, len(words))
    joined = b" ".join(words)
    starts = np.cumsum([0] + [len(w) + 1 for w in words])
    first, last = starts[:len(words) - k + 1].tolist(), (starts[k:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)), np.uint64, len(first))
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(h), BLOCK):
        ones += np.unpackbits(h[lo:lo + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def _fingerprints(k: int):
    def run(batches):
        for batch in batches:
            f = np.array([fingerprint(t.as_py(), k) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(f.view(np.int64))], names=["id", "fp"])
    return run


def _rotated(fp, i) -> F.Column:
    """``fp`` with segment ``i`` in front, in the lowest bits."""
    return F.expr(f"shiftrightunsigned({fp}, {WIDTH} * {i}) | if({i} = 0, 0L, shiftleft({fp}, 64 - {WIDTH} * {i}))")


def _masks(bits: int, most: int, low: int = 0) -> list[int]:
    """Every way to change ``most`` of ``bits`` bits at most, from bit ``low`` on."""
    out = level = [(0, 0)]
    for _ in range(most):
        level = [(m | 1 << b, b + 1) for m, start in level for b in range(start, bits)]
        out = out + level
    return [m << low for m, _ in out]


def _each(value: str, masks: list[int]) -> F.Column:
    """One row per mask: ``value`` with the mask's bits changed."""
    return F.explode(F.transform(F.array(*map(F.lit, masks)), lambda m: F.col(value).bitwiseXOR(m.cast("long"))))


def links(classes: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b) over distinct fingerprints ``fp`` whose components are those of
    all links; each pair is a link."""
    low = (1 << 2 * WIDTH) - 1
    ring = classes.select("fp", F.explode(F.array(*map(F.lit, range(SEGMENTS)))).alias("i")).withColumn("r", _rotated("fp", "i"))
    # the segment's number stands above the 32 bits of the key
    own = F.shiftleft(F.col("i").cast("long"), 2 * WIDTH).bitwiseOR(F.col("r").bitwiseAND(F.lit(low)))
    stands = ring.select("fp", "r", own.alias("key"))
    looks = stands.select("fp", "r", F.col("key").alias("own"), _each("key", _masks(WIDTH, 1, WIDTH)).alias("key"))
    busy = written(stands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot).select("key"), "simhash-busy")

    differ = F.col("r").bitwiseXOR(F.col("r2"))
    chain = F.bit_count(differ.bitwiseAND(F.lit((1 << 3 * WIDTH) - 1))) <= 2
    there = stands.join(busy, "key", "left_anti").select("key", F.col("fp").alias("fp2"), F.col("r").alias("r2"))
    pairs = looks.join(there, "key").filter(F.col("fp") < F.col("fp2")).filter(chain).filter(F.bit_count(differ) <= TAU) \
        .select(F.col("fp").alias("a"), F.col("fp2").alias("b"))

    half = F.shiftrightunsigned("r", 2 * WIDTH).alias("half")
    place = stands.join(busy, "key", "left_semi").select("key", "fp", half).select("key", "fp", _each("half", _masks(2 * WIDTH, 1)).alias("place"))
    lowest = place.groupBy("key", "place").agg(F.min("fp").alias("fp2"))
    seen = looks.join(busy, "key", "left_semi").select("key", "fp", half, (F.col("key") == F.col("own")).alias("same"))
    sight = seen.filter("same").select("key", "fp", _each("half", _masks(2 * WIDTH, 2)).alias("place")).unionByName(
        seen.filter("not same").select("key", "fp", _each("half", _masks(2 * WIDTH, 1)).alias("place")))
    met = sight.join(lowest, ["key", "place"]).filter("fp <> fp2").select(F.least("fp", "fp2").alias("a"), F.greatest("fp", "fp2").alias("b"))
    return pairs.unionByName(met)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, hot: int = HOT) -> DataFrame:
    """One row per input row: id, fp (the fingerprint as a signed long),
    component_id (smallest id its links reach)."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    facts = written(src.mapInArrow(_fingerprints(shingle), f"id {id_type}, fp long"), "simhash-facts")
    known = facts.filter("id is not null")
    classes = written(known.groupBy("fp").agg(F.min("id").alias("lowest")), "simhash-classes")
    edges = written(links(classes.select("fp"), hot), "simhash-links")
    # an id with several texts ties their fingerprints together
    several = known.groupBy("id").agg(F.min("fp").alias("a"), F.max("fp").alias("top")).filter("a <> top").select("id", "a")
    tied = known.join(several, "id").select("a", F.col("fp").alias("b"))
    roots = components(edges.unionByName(tied), "simhash-roots")
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "lowest", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("lowest").alias("component"))
    named = rooted.join(least, "root").select("fp", "component")
    out = facts.join(named, "fp", "left")
    return out.select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component_id"))
