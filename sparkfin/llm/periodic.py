"""Periodic runs by internal pattern matching.

A run is a stretch of consecutive words with smallest period q and at least
``max(LEAST, REPEATS * q)`` words that no neighbouring word extends keeping
period q.  A word is dropped if a run holds it after that run's first q words.

Words become numbers that differ between documents, so many documents are
searched as one text and no match crosses documents.  Its suffix array comes
from prefix doubling; the ranks kept at every level name the places where a
block of 2^k words occurs as one range of the suffix array, and tell how far
two places agree to the right or to the left.

Of a run of length L and period q, all but the last q words hold an aligned
block of B = 2^k words with 2B - 1 <= L - q, so q < 2B, and the block occurs
again q words on.  Every dyadic block therefore asks for its occurrences in the
window of the next 2B - 1 places: a wavelet tree over the suffix array answers
"smallest place >= x in this range" (range successor).  Occurrences at most
B / 2 apart are a progression whose step is the block's own period; a
progression is taken as a whole, so a window has a few answers however often
the block occurs.  Candidate periods are the distance to an occurrence, the
step, and the distance at which the block's own stretch of that step lies
against the progression's (a run that shifts one onto the other shifts its
first or its last word).  Each candidate is extended to both sides and held to
the length asked for; of candidates with the same stretch the smallest is the
period.

Work is O(n log n) array operations per group of about ``GROUP`` words; a longer
document is a group of its own, and documents are only mapped.

Defined results: a null or empty text has no words, no runs and an empty
collapsed text; repeated rows come back as often as they came; a null id is
carried; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import WORD, byte_words

LEAST, REPEATS = 24, 3
GROUP = 150_000
#: level of the shortest block: a run's L - q words are 16 at least
FIRST = 3
NONE = np.iinfo(np.int64).max


class Suffixes:
    """Suffix array by prefix doubling, with the ranks of every level.

    ``rank[k][i]``: first slot of the suffixes that begin with the same 2^k
    symbols as suffix i; ``size[k]``: how many there are, by that slot."""

    def __init__(self, symbols: np.ndarray, levels: int):
        n = len(symbols)
        self.n, self.sa = n, np.argsort(symbols, kind="stable")
        slots = np.arange(n)
        s = symbols[self.sa]
        first = np.maximum.accumulate(np.where(np.append(True, s[1:] != s[:-1]), slots, 0))
        rank = np.empty(n, np.int64)
        rank[self.sa] = first
        self.rank, self.size = [rank], [np.bincount(rank, minlength=n)]
        for k in range(levels):
            rank, size = self.rank[-1], self.size[-1]
            # only symbols that still share their slot are sorted further
            act = np.flatnonzero(size[rank] > 1)
            if not len(act):
                break
            after = act + (1 << k)
            key = rank[act] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
            order = np.argsort(key, kind="stable")
            act, key = act[order], key[order]
            own = rank[act]
            at = np.arange(len(act))
            slot = own + at - np.maximum.accumulate(np.where(np.append(True, own[1:] != own[:-1]), at, 0))
            self.sa[slot] = act
            new = rank.copy()
            new[act] = slot[np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), at, 0))]
            self.rank.append(new)
            self.size.append(np.bincount(new, minlength=n))

    def agree(self, a: np.ndarray, b: np.ndarray, left: bool = False) -> np.ndarray:
        """Number of equal symbols from places a < b on; ``left``: before them."""
        a, b = a.copy(), b.copy()
        out = np.zeros(len(a), np.int64)
        sign = -1 if left else 1
        for k in range(len(self.rank) - 1, -1, -1):
            step, rank = 1 << k, self.rank[k]
            back = step if left else 0
            go = np.arange(len(a))
            while len(go):  # only the longest blocks may fit more than once
                x, y = a[go] - back, b[go] - back
                ok = (x >= 0) & (y < self.n)
                ok[ok] = rank[x[ok]] == rank[y[ok]]
                go = go[ok]
                a[go] += sign * step
                b[go] += sign * step
                out[go] += step
                if k < len(self.rank) - 1:
                    break
        return out


class WaveletTree:
    """Range successor over an array of numbers below 2^bits, for arrays of
    queries: level by level, zeros to the left and ones to the right."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.zeros, self.edge = [], []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            self.zeros.append(np.append(0, np.cumsum(~one)))
            self.edge.append(int(self.zeros[-1][-1]))
            values = np.concatenate([values[~one], values[one]])

    def _below(self, lo, hi, x):
        """How many values of slots lo..hi-1 are smaller than x."""
        out = np.zeros(len(lo), np.int64)
        for d, (zeros, edge) in enumerate(zip(self.zeros, self.edge, strict=True)):
            one = (x >> (self.bits - 1 - d) & 1).astype(bool)
            a, b = zeros[lo], zeros[hi]
            out += np.where(one, b - a, 0)
            lo, hi = np.where(one, edge + lo - a, a), np.where(one, edge + hi - b, b)
        return out

    def _ranked(self, lo, hi, k):
        """The k-th smallest value, from 0, of slots lo..hi-1."""
        out = np.zeros(len(lo), np.int64)
        for zeros, edge in zip(self.zeros, self.edge, strict=True):
            a, b = zeros[lo], zeros[hi]
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            lo, hi = np.where(one, edge + lo - a, a), np.where(one, edge + hi - b, b)
            out = out << 1 | one
        return out

    def successor(self, lo, hi, x) -> np.ndarray:
        """Smallest value >= x of slots lo..hi-1, ``NONE`` if there is none."""
        out = np.full(len(lo), NONE)
        ok = np.flatnonzero((x >> self.bits == 0) & (lo < hi))
        below = self._below(lo[ok], hi[ok], x[ok])
        has = below < hi[ok] - lo[ok]
        ok = ok[has]
        out[ok] = self._ranked(lo[ok], hi[ok], below[has])
        return out


def _candidates(s: Suffixes, tree: WaveletTree, slot_of: np.ndarray, k: int):
    """(place, period) candidates of the blocks of 2^k symbols."""
    b = 1 << k
    place = np.arange(0, s.n - b + 1, b)
    place = place[s.size[k][s.rank[k][place]] > 1]
    slot = s.rank[k][place]
    lo, hi = slot_of[slot], slot_of[slot + s.size[k][slot]]
    x, last = place + 1, place + 2 * b - 1
    while len(place):
        one = tree.successor(lo, hi, x)
        ok = one <= last
        place, lo, hi, last, one = place[ok], lo[ok], hi[ok], last[ok], one[ok]
        if not len(place):
            return
        yield place, one - place
        two = tree.successor(lo, hi, one + 1)
        x = one + 1
        near = np.flatnonzero((two < NONE) & (two - one <= b // 2))
        if len(near):
            p, q, step = place[near], one[near], two[near] - one[near]
            yield p, step
            end = q + step + s.agree(q, q + step)
            yield p, end - (p + step + s.agree(p, p + step))
            yield p, (q - s.agree(q, q + step, left=True)) - (p - s.agree(p, p + step, left=True))
            # on behind the progression's last occurrence
            x[near] = q + (end - b - q) // step * step + 1


def runs_of(symbols: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start and period; ``longest``:
    length of the longest document in ``symbols``."""
    none = np.empty((0, 3), np.int64)
    if longest < LEAST:
        return none
    levels = max(FIRST, (longest // 2).bit_length() - 1)
    s = Suffixes(symbols, levels)
    if len(s.rank) <= FIRST:
        return none  # no block of 2^FIRST symbols occurs twice
    # the tree holds the slots whose block of 2^FIRST symbols occurs again
    shared = s.size[FIRST][s.rank[FIRST][s.sa]] > 1
    if not shared.any():
        return none
    slot_of = np.append(0, np.cumsum(shared))
    tree = WaveletTree(s.sa[shared])
    found = [none]
    for k in range(FIRST, len(s.rank)):
        for place, period in _candidates(s, tree, slot_of, k):
            ok = (period > 0) & (place + period < s.n)
            if not ok.any():
                continue
            place, period = place[ok], period[ok]
            start = place - s.agree(place, place + period, left=True)
            end = place + period + s.agree(place, place + period)
            ok = end - start >= np.maximum(LEAST, REPEATS * period)
            found.append(np.unique(np.stack([start[ok], end[ok], period[ok]], axis=1), axis=0))
    got = np.unique(np.concatenate(found), axis=0)  # by start, end, period
    first = np.append(True, (got[1:, :2] != got[:-1, :2]).any(axis=1))[:len(got)]
    got = got[first]
    return got[np.lexsort((got[:, 2], got[:, 0]))]


def _groups(texts):
    """Texts of a batch in groups of about ``GROUP`` words."""
    part, n = [], 0
    for text in texts:
        words = byte_words(text.as_py())
        part.append(words)
        n += len(words)
        if n >= GROUP:
            yield part
            part, n = [], 0
    if part:
        yield part


def group_runs(docs: list[list[bytes]]) -> list[np.ndarray]:
    """Runs of each document, (start, end, period) in word numbers."""
    ids: dict[bytes, int] = {}
    counts = np.array([len(w) for w in docs])
    numbers = np.fromiter((ids.setdefault(w, len(ids)) for words in docs for w in words), np.int64, counts.sum())
    owner = np.repeat(np.arange(len(docs)), counts)
    got = runs_of(owner * max(1, len(ids)) + numbers, int(counts.max(initial=0)))
    starts = np.cumsum(counts) - counts
    of = owner[got[:, 0]] if len(got) else np.empty(0, np.int64)
    got[:, :2] -= starts[of][:, None]
    edges = np.searchsorted(of, np.arange(len(docs) + 1))
    return [got[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def collapsed(words: list[bytes], runs: np.ndarray) -> str:
    """The words that no run holds after its first period, blank between."""
    if len(runs):
        mark = np.zeros(len(words) + 1, np.int64)
        np.add.at(mark, runs[:, 0] + runs[:, 2], 1)
        np.add.at(mark, runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(mark[:-1]) == 0).tolist()]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def _run(batches):
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        lo = 0
        for docs in _groups(batch.column(1)):
            runs = group_runs(docs)
            flat = np.concatenate([*runs, np.empty((0, 3), np.int64)])
            spans = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1] - flat[:, 0]), pa.array(flat[:, 2])], fields=list(kind))
            ends = np.cumsum([0] + [len(r) for r in runs], dtype=np.int32)
            text = [collapsed(w, r) for w, r in zip(docs, runs, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(docs)), pa.ListArray.from_arrays(pa.array(ends), spans), pa.array(text, pa.string())],
                                             names=["id", "runs", "collapsed"])
            lo += len(docs)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: id, runs (start, length, period in words, by start and
    period), collapsed (the kept words, one blank between)."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(_run, f"id {src.schema['id'].dataType.simpleString()}, "
                                "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def strongest(runs: str = "runs") -> F.Column:
    """The run with the greatest length / period, compared exactly; of equal
    ones that with the smallest start, then period; null without runs."""
    def order(x, y):
        here, there = x["length"] * y["period"], y["length"] * x["period"]
        return F.when(here > there, -1).when(here < there, 1).when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1) \
            .when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0)
    return F.get(F.array_sort(runs, order), 0)


def listing(runs: str = "runs") -> F.Column:
    """One line ``start,length,period`` per run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text): a tenth of the documents, drawn by the id's CRC, goes on
    periodically from a drawn word; the others, and rows without id, are as
    they were."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(WORD), F.lit(0))
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), h.alias("h"),
                    F.when(h % 10 == 0, words).alias("w"))
    d = d.withColumn("n", F.size("w").cast("long")).withColumn("g", F.floor(F.col("h") / 10).cast("long"))
    a = F.col("g") % F.col("n")
    p = 1 + F.floor((F.col("n") - a) / (3 + F.col("g") % 8)).cast("long")
    d = d.withColumn("a", F.when(F.col("n") > 0, a)).withColumn("p", F.when(F.col("n") > 0, p))
    changed = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get(
        F.col("w"), F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))), " ")
    return d.select("id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))
