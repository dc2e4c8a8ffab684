"""Substring dedup by relative Lempel-Ziv parsing.

The reference is the corpus itself, indexed by anchors: of the ``k``-word
grams inside each window the one with the smallest hash (k is just over half a
window, so neighbouring anchors of a text touch).  The index keeps the first
occurrence of every anchor that occurs more than once.  Each document is then
parsed greedily: an anchor that the reference holds opens a factor, and the
factor grows as long as the next anchor continues the same stretch of the same
reference document without a gap.  Every word of a factor equals its reference
word, so all whole windows inside a factor repeat earlier text.

Factors are checked at their boundaries: a window that holds an indexed anchor
but does not lie inside a factor may still repeat text elsewhere.  Only such
windows, and those of the references that share their anchor, are hashed in
full (128 bits) and compared by first occurrence.  A window's anchor depends on
its words alone, so no repeated window escapes.

Anchors are counted with map-side combining; joins are plain equi-joins on
anchor or document.  Windows over rows are keyed by document and bounded by
one text.  Texts are shuffled once and the exchange is shared.

Defined results: a null text has no words; order is (id, position), a null id
first; rows repeated with id and text are one document and each comes back
with its result; an id repeated with other texts is a document per text, in
order of a hash of the text; an empty table gives an empty result; other
columns are not read.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import byte_words, gram_hashes, mixed, odd_constants, release, text_groups, written

WINDOW = 20
SEED = 9


def leftmost_smallest(g: np.ndarray, w: int) -> np.ndarray:
    """Place of the first smallest value in every run of ``w`` values."""
    value, place, span = g, np.arange(len(g)), 1
    while span < w:
        step = min(span, w - span)
        later = value[step:] < value[:-step]
        value = np.where(later, value[step:], value[:-step])
        place = np.where(later, place[step:], place[:-step])
        span += step
    return place


def anchor_rows(counts: np.ndarray, h: np.ndarray, window: int, c: np.ndarray):
    """Anchors of texts given one after the other by their word counts and word
    hashes: (text, hash, at, lo, hi); the text's windows that start at lo..hi
    have this anchor at ``at``."""
    k = len(c)
    w = window - k + 1
    if len(h) < window:
        return (np.empty(0, np.int64), np.empty(0, np.uint64)) + (np.empty(0, np.int64),) * 3
    g = gram_hashes(h, c)
    best = leftmost_smallest(g, w)
    starts = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(counts)), counts)[:len(best)]
    inside = np.flatnonzero(np.arange(len(best)) + window <= starts[owner + 1])  # windows that do not leave their text
    best, owner = best[inside], owner[inside]
    new = np.flatnonzero(np.concatenate([[True], (best[1:] != best[:-1]) | (owner[1:] != owner[:-1])])) if len(best) else np.empty(0, np.int64)
    last = np.append(new[1:], len(best)) - 1 if len(best) else new
    text = owner[new]
    return text, g[best[new]], best[new] - starts[text], inside[new] - starts[text], inside[last] - starts[text]


def _anchors(window: int):
    k = window // 2 + 1

    def run(batches):
        c = odd_constants(window, SEED)[:k]
        for batch in batches:
            for numbers, counts, h in text_groups(batch.column(1)):
                text, g, at, lo, hi = anchor_rows(counts, h, window, c)
                if len(text):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g.view(np.int64)), batch.column(0).take(pa.array(numbers[text])),
                         pa.array((at << 16) | ((at - lo) << 8) | (at - hi))], names=["anchor", "key", "place"])
    return run


def _windows(window: int):
    """Full hashes of the windows that start in the listed ranges."""
    def run(batches):
        c1, c2, reach = odd_constants(window, SEED + 1), odd_constants(window, SEED + 2), np.arange(window)
        for batch in batches:
            ranges = batch.column(2)
            for numbers, counts, h in text_groups(batch.column(1)):
                starts = np.concatenate([[0], np.cumsum(counts)])
                owner, at = [], []
                for j, i in enumerate(numbers.tolist()):
                    p = np.unique(np.concatenate([np.arange(r["lo"], r["hi"] + 1) for r in ranges[i].as_py()]))
                    at.append(p + starts[j])
                    owner.append(np.full(len(p), j))
                at, owner = np.concatenate(at), np.concatenate(owner)
                for z in range(0, len(at), 1 << 16):
                    p, o = at[z:z + (1 << 16)], owner[z:z + (1 << 16)]
                    words = h[p[:, None] + reach]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mixed((words * c).sum(axis=1, dtype=np.uint64)).view(np.int64)) for c in (c1, c2)]
                        + [batch.column(0).take(pa.array(numbers[o])), pa.array(p - starts[o])], names=["w1", "w2", "key", "start"])
    return run


def covered(n: int, spans) -> np.ndarray:
    """Mask of the words inside any span (start, end)."""
    d = np.zeros(n + 1, np.int64)
    for a, b in spans:
        d[a] += 1
        d[b] -= 1
    return np.cumsum(d[:n]) > 0


def _cut(window: int):
    def run(batches):
        for batch in batches:
            n_words, n_removed, digests, kept = [], [], [], []
            for text, spans, starts in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                words = byte_words(text.as_py())
                gone = [(s["cs"], s["ce"]) for s in spans.as_py() or ()] + [(p, p + window) for p in starts.as_py() or ()]
                if gone:
                    mask = covered(len(words), gone)
                    rest = [w for w, x in zip(words, mask.tolist(), strict=True) if not x]
                else:
                    rest = words
                text_left = b" ".join(rest)
                n_words.append(len(words))
                n_removed.append(len(words) - len(rest))
                digests.append(hashlib.sha256(text_left).hexdigest())
                kept.append(text_left.decode("utf-8", "surrogatepass") if gone else text.as_py())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())],
                names=["row", "kept_text", "n_words", "n_removed", "kept_sha256"])
    return run


def parse(src: DataFrame, key_type: str, window: int) -> DataFrame:
    """Anchors of (key, text) that the reference index holds, each with the
    bounds (cs, ce) of its factor; ``first`` marks the reference itself."""
    k = window // 2 + 1
    anchors = src.mapInArrow(_anchors(window), f"anchor long, key {key_type}, place long")
    index = anchors.groupBy("anchor").agg(F.min("key").alias("ref"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # each aggregate is a table of its own before its join: both sides are plain
    # exchanges then, and a hot anchor can be split
    index = written(index, "substring-index")
    hits = written(anchors.join(index, "anchor"), "substring-hits")
    head = written(hits.filter(F.col("key") == F.col("ref")).groupBy("anchor").agg(F.min("place").alias("ref_place")), "substring-heads")
    rows = hits.join(head, "anchor")

    at, ref_at = F.shiftright("place", 16), F.shiftright("ref_place", 16)
    rows = rows.select("anchor", "key", "ref", at.alias("at"), ref_at.alias("ref_at"),
                       (at - F.shiftright("place", 8).bitwiseAND(255)).alias("lo"), (at - F.col("place").bitwiseAND(255)).alias("hi"))
    rows = rows.withColumn("first", (F.col("key") == F.col("ref")) & (F.col("at") == F.col("ref_at")))
    line = Window.partitionBy("key").orderBy("at")
    step = F.col("at") - F.lag("at").over(line)
    goes_on = (~F.col("first") & ~F.lag("first").over(line) & (F.lag("ref").over(line) == F.col("ref"))
               & (step <= k) & (step == F.col("ref_at") - F.lag("ref_at").over(line)))
    rows = rows.withColumn("opens", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1))
    rows = rows.withColumn("factor", F.sum("opens").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("key", "factor")
    out = written(rows.withColumn("cs", F.min("at").over(whole)).withColumn("ce", F.max("at").over(whole) + k)
                  .select("anchor", "key", "lo", "hi", "first", "cs", "ce"), "substring-factors")
    release(hits, index, head)
    return out


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """Every input row as (row, text, spans, starts): ``row`` holds the id and
    the carried columns, ``spans`` are factors of at least a window, ``starts``
    single repeated windows outside of them."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                      F.struct(F.col(id_col).alias("id"), *carry).alias("row"))
    tag = F.xxhash64("text")
    odd = src.groupBy("id").agg(F.min(tag).alias("lo"), F.max(tag).alias("hi")).filter("lo <> hi or id is null")
    src = src.withColumn("key", F.col("id") if odd.isEmpty() else F.struct("id", tag.alias("tag")))
    key_type = src.schema["key"].dataType.simpleString()
    rows = parse(src.select("key", "text"), key_type, window)

    spans = rows.filter(~F.col("first") & (F.col("ce") - F.col("cs") >= window)).groupBy("key") \
        .agg(F.collect_set(F.struct("cs", "ce")).alias("spans"))
    # windows of an anchor that its factor does not hold: before, after, or all
    short = F.col("first") | (F.col("ce") - F.col("cs") < window)
    pieces = F.array(
        F.struct(F.col("lo"), F.when(short, F.col("hi")).otherwise(F.least("hi", F.col("cs") - 1)).alias("hi")),
        F.struct(F.when(short, F.col("hi") + 1).otherwise(F.greatest("lo", F.col("ce") - window + 1)).alias("lo"), F.col("hi")))
    loose = rows.select("anchor", "key", "first", F.explode(pieces).alias("p")).filter("p.lo <= p.hi")
    asked = loose.filter(~F.col("first")).select("anchor").distinct()
    checks = loose.join(asked, "anchor", "left_semi").groupBy("key").agg(F.collect_list("p").alias("ranges"))
    checks = written(checks, "substring-checks")
    full = src.select("key", "text").join(checks, "key").mapInArrow(_windows(window), f"w1 long, w2 long, key {key_type}, start long")
    first = full.groupBy("w1", "w2").agg(F.min(F.struct("key", "start")).alias("m"))
    again = full.join(first, ["w1", "w2"]).filter(F.struct("key", "start") > F.col("m")) \
        .groupBy("key").agg(F.collect_set("start").alias("starts"))
    return src.join(spans, "key", "left").join(again, "key", "left").select("row", "text", "spans", "starts")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, the carried columns, kept_text (the kept
    words joined by one blank; the text itself where nothing was removed),
    n_words, n_removed and kept_sha256 (of the kept words joined by one blank)."""
    found = repeated_spans(docs, id_col, text_col, window, carry)
    row = found.schema["row"].dataType.simpleString()
    return found.mapInArrow(_cut(window), f"row {row}, kept_text string, n_words long, n_removed long, kept_sha256 string") \
        .select("row.*", "kept_text", "n_words", "n_removed", "kept_sha256")


ORACLE = r"""
with w as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as words from documents),
p as (select doc_id, unnest(range(0, greatest(len(words) - 19, 0))) as pos, words from w),
h as (select doc_id, pos, md5(array_to_string(words[pos + 1: pos + 20], ' ')) as win from p),
f as (select *, row_number() over (partition by win order by doc_id, pos) as nth from h),
g as (select distinct doc_id, unnest(range(pos, pos + 20)) as word from f where nth > 1),
m as (select doc_id, list(word) as gone from g group by doc_id)
select w.doc_id, len(words)::bigint as n_words, coalesce(len(gone), 0)::bigint as n_removed,
       sha256(array_to_string(list_transform(list_filter(list_zip(words, range(0, len(words))),
              lambda x: gone is null or not list_contains(gone, x[2])), lambda x: x[1]), ' ')) as kept_sha256
from w left join m using (doc_id)
"""
