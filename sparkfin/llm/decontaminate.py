"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may occur with at most k = m // 15 edits.  Cut
into k + 1 pieces, at least one piece of any such occurrence is untouched.
All pieces of a block of items form one Aho-Corasick automaton that runs over
every whole document; a piece hit fixes where the item would start, hits of an
item with nearby starts are one region, and Myers' bit-parallel algorithm
verifies the region with one machine-independent big integer per column.

Both sides are lower-cased and runs of blanks become one blank.  Items go to
the tasks in blocks of a stated number of characters, one pass over the
documents per block, so what is shipped is bounded however large the test set
is.  Documents are only mapped; nothing is shuffled but the matches.

Defined results: a null or empty item matches nothing and a null or empty text
holds nothing; items too short for one edit must match as whole words; items
repeated with id and text are one; every (document row, item) pair is one row
with its best match, so a repeated document is reported as often as it occurs;
empty tables give an empty result; other columns are not read.
"""
from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: characters of an item per tolerated edit
CHARS_PER_EDIT = 15
#: characters of test items handled in one pass
BLOCK_CHARS = 400_000


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def budget(m: int) -> int:
    return m // CHARS_PER_EDIT


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece) of the budget + 1 nearly equal pieces of an item."""
    n = budget(len(item)) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def column_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        masks[ch] = masks.get(ch, 0) | 1 << i
    return masks


def myers(m: int, masks: dict[str, int], text: str, anchored: bool = False) -> tuple[int, int]:
    """(distance, end): the least edit distance between the pattern and a part
    of ``text`` and the end of the first part that has it.  ``anchored`` parts
    start where the text starts."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, at = m, 0
    for j, ch in enumerate(text, 1):
        eq = masks.get(ch, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | (full & ~(xh | plus)), plus & xh
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1 | anchored) & full, (down << 1) & full
        plus, minus = down | (full & ~(xv | up)), up & xv
        if score < best:
            best, at = score, j
    return best, at


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple]):
        import ahocorasick

        self.items = [(key, item, column_masks(item), column_masks(item[::-1])) for key, item in items if item]
        found: dict[str, list] = {}
        for number, (_, item, _, _) in enumerate(self.items):
            for offset, piece in pieces(item):
                found.setdefault(piece, []).append((number, offset + len(piece)))
        self.auto = ahocorasick.Automaton()
        for piece, uses in found.items():
            self.auto.add_word(piece, uses)
        if found:
            self.auto.make_automaton()

    def matches(self, text: str) -> list[tuple]:
        """(item key, distance, start, end) of each item's best match."""
        if not self.items or not text:
            return []
        starts: dict[int, set[int]] = {}
        for end, uses in self.auto.iter(text):
            for number, done in uses:
                starts.setdefault(number, set()).add(end + 1 - done)
        out = []
        for number, at in starts.items():
            best = self._best(number, sorted(at), text)
            if best:
                out.append((self.items[number][0], *best))
        return out

    def _best(self, number: int, at: list[int], text: str):
        _, item, masks, back = self.items[number]
        m, k, best = len(item), budget(len(item)), None
        for a in at:  # an exact occurrence needs no verification
            if a >= 0 and text.startswith(item, a) and (k or self._whole(text, a, a + m)):
                return 0, a, a + m
        if not k:
            return None
        regions: list[list[int]] = []
        for a in at:
            if regions and a - regions[-1][1] <= 2 * k:
                regions[-1][1] = a
            else:
                regions.append([a, a])
        for lo, hi in regions:
            lo = max(0, lo - k)
            part = text[lo:hi + m + k]
            distance, end = myers(m, masks, part)
            if distance <= k and (best is None or distance < best[0]):
                _, size = myers(m, back, part[:end][::-1], anchored=True)
                best = distance, lo + end - size, lo + end
        return best

    @staticmethod
    def _whole(text: str, a: int, b: int) -> bool:
        return not (a and text[a - 1].isalnum()) and not (b < len(text) and text[b].isalnum())


def _search(items: list[tuple], item_type: pa.DataType):
    def run(batches):
        matcher = Matcher(items)
        for batch in batches:
            owner, rows = [], []
            for i, text in enumerate(batch.column(1)):
                found = matcher.matches(normal(text.as_py()))
                rows += found
                owner += [i] * len(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), pa.array([r[0] for r in rows], item_type),
                 *(pa.array([r[j] for r in rows], pa.int64()) for j in (1, 2, 3))],
                names=["id", "item", "distance", "start", "end"])
    return run


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
          item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, item, distance, start, end) for every document that holds a test
    item within its edit budget; positions count normalised characters."""
    from pyspark.sql.pandas.types import to_arrow_type

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    tests = benchmark.select(F.col(item_id).alias("item"), F.col(item_text).cast("string").alias("body")).filter("body is not null").distinct()
    schema = f"id {src.schema['id'].dataType.simpleString()}, item {tests.schema['item'].dataType.simpleString()}, distance long, start long, end long"
    total = tests.agg(F.coalesce(F.sum(F.length("body")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(2 * total / block_chars)) if total > block_chars else 1
    block = F.pmod(F.xxhash64("item", "body"), F.lit(blocks))
    out = None
    for b in range(blocks):
        items = [(r.item, normal(r.body)) for r in tests.filter(block == b).collect()]
        found = src.mapInArrow(_search(items, to_arrow_type(tests.schema["item"].dataType)), schema)
        out = found if out is None else out.unionByName(found)
    return out
