"""Fill-in-the-middle transformation with content-defined chunk memoization.

A text is cut at two token boundaries drawn from its id into prefix, middle
and suffix, and written with sentinels in PSM or SPM order, or left plain.

Where the k-th token ends is found without tokenizing the text.  A rolling hash
over ``WINDOW`` bytes cuts the text into chunks, so passages that texts share
become equal chunks wherever they stand.  A chunk's boundary summary says how
many words end inside it, how many code points it has, and whether it begins
and ends with a blank; a word ends between two chunks if a blank follows a
word.  Summaries are kept in a content cache whose key is the chunk's bytes,
so a hit is verified by its content, not by a hash.  Adding up the counts
finds the one chunk that holds the cut; only that chunk is searched.

The cache belongs to a task and is bounded by ``CACHE_BYTES``; a lost executor
loses nothing but summaries.  Documents are mapped, nothing is shuffled.

Defined results: a null text is the empty text; an empty text is plain, has no
tokens and stays as it is; a row without id draws as if its id were the empty
text; repeated rows come back as often as they came; an empty table gives an
empty result; other columns are not read.
"""
from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 42
#: percent of texts that are transformed, and of those, that are SPM
RATE, SPM = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)

#: bytes of the rolling hash; a cut wherever its lowest bits are 0
WINDOW, CUT_BITS = 32, 9
LEAST, MOST = 64, 4096
CACHE_BYTES = 32 << 20

_BLANK = frozenset(b"\x20\x09\x0a\x0b\x0c\x0d")
_WORD_END = re.compile(rb"[^\x20\x09-\x0D][\x20\x09-\x0D]")
_CONTINUED = bytes(range(0x80, 0xC0))
_GEAR = np.random.default_rng(SEED).integers(0, 2**32, 256, dtype=np.uint32)
_STEPS = np.random.default_rng(SEED + 1).integers(0, 2**31, 5, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def chunk_ends(raw: bytes) -> list[int]:
    """Ends of the chunks of ``raw``, the last one its length."""
    h = _GEAR[np.frombuffer(raw, np.uint8)]
    for j, c in enumerate(_STEPS):  # the hash of 2, 4, .. bytes from two of half as many
        if len(h) <= 1 << j:
            h = h[:0]
            break
        h = h[:-(1 << j)] * c + h[1 << j:]
    out, last = [], 0
    for end in (np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + WINDOW).tolist() + [len(raw)]:
        while end - last > MOST:
            last += MOST
            out.append(last)
        if end - last >= LEAST or end == len(raw) > last:
            out.append(end)
            last = end
    return out


def summary(chunk: bytes) -> tuple[int, int, bool, bool]:
    """(words that end before a blank of the chunk, code points, begins with a
    blank, ends with a blank)."""
    return len(_WORD_END.findall(chunk)), len(chunk.translate(None, _CONTINUED)), chunk[0] in _BLANK, chunk[-1] in _BLANK


class ContentCache:
    """Boundary summaries by the chunk's own bytes; the oldest go first when
    the kept bytes pass the bound."""

    def __init__(self, most: int = CACHE_BYTES):
        self.most, self.kept, self.held, self.hits, self.misses = most, {}, 0, 0, 0

    def summary(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        found = self.kept.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        self.misses += 1
        found = self.kept[chunk] = summary(chunk)
        self.held += len(chunk)
        while self.held > self.most:
            oldest = next(iter(self.kept))
            del self.kept[oldest]
            self.held -= len(oldest)
        return found


class Counts:
    """Tokens of a text, from the summaries of its chunks."""

    def __init__(self, raw: bytes, cache: ContentCache):
        self.raw, self.starts, self.before, self.points = raw, [0], [0], [0]
        words = points = 0
        after_word = False
        for end in chunk_ends(raw):
            inside, n, opens, closes = cache.summary(raw[self.starts[-1]:end])
            # the word that the chunk before ends with ends here
            words += after_word and opens
            self.before[-1] = words
            words, points, after_word = words + inside, points + n, not closes
            self.starts.append(end)
            self.before.append(words)
            self.points.append(points)
        self.words = words + after_word
        #: blanks after the last word are a token of their own
        self.n = self.words + (len(raw) > 0 and not after_word)

    def cut(self, k: int) -> tuple[int, int]:
        """(byte, code point) where the first ``k`` tokens end."""
        if k == 0:
            return 0, 0
        if k == self.n:
            return len(self.raw), self.points[-1]
        # the last chunk before whose first byte fewer than k words end
        lo, hi = 0, len(self.before) - 1
        while hi - lo > 1:
            at = (lo + hi) // 2
            lo, hi = (at, hi) if self.before[at] < k else (lo, at)
        start, end = self.starts[lo], self.starts[lo + 1]
        want = k - self.before[lo]
        for m in _WORD_END.finditer(self.raw, start, end):
            want -= 1
            if want == 0:
                here = m.start() + 1
                return here, self.points[lo] + len(self.raw[start:here].translate(None, _CONTINUED))
        return end, self.points[lo + 1]  # it ends with the chunk


def draws(id_text: str) -> list[int]:
    h = hashlib.sha256(f"{SEED}:{id_text}".encode()).hexdigest()
    return [int(h[8 * j:8 * j + 8], 16) for j in range(4)]


def transformed(id_text: str, text: str | None, cache: ContentCache, rate: int = RATE, spm: int = SPM) -> tuple:
    """(tokens, form, prefix and middle in code points, output)."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    counts = Counts(raw, cache)
    h1, h2, h3, h4 = draws(id_text)
    if not text or any(s in text for s in SENTINELS) or h3 % 100 >= rate:
        return counts.n, "plain", None, None, text
    one, two = sorted((h1 % (counts.n + 1), h2 % (counts.n + 1)))
    (a, points), (b, more) = counts.cut(one), counts.cut(two)
    prefix, middle, suffix = (x.decode("utf-8", "surrogatepass") for x in (raw[:a], raw[a:b], raw[b:]))
    if h4 % 100 < spm:
        return counts.n, "spm", points, more - points, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return counts.n, "psm", points, more - points, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = RATE, spm: int = SPM) -> DataFrame:
    """Per input row: id, n (tokens), form (plain, psm or spm), prefix_chars,
    middle_chars (null if plain), output."""
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id_text"),
                      F.col(text_col).cast("string").alias("text"))

    def run(batches):
        cache = ContentCache()
        for batch in batches:
            got = [transformed(i.as_py(), t.as_py(), cache, rate, spm) for i, t in zip(batch.column(1), batch.column(2), strict=True)]
            n, form, prefix, middle, output = zip(*got, strict=True) if got else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n long, form string, "
                               "prefix_chars long, middle_chars long, output string")


def restored(output: str = "output", form: str = "form") -> F.Column:
    """The text that an output was made from."""
    p = F.split(F.col(output), "|".join(SENTINELS))  # nothing, then the three parts in the order written
    return F.when(F.col(form) == "plain", F.col(output)) \
        .when(F.col(form) == "psm", F.concat(p[1], p[3], p[2])).otherwise(F.concat(p[2], p[3], p[1]))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
             [('0x' || substr(h, 8 * j + 1, 8))::UBIGINT::BIGINT FOR j IN [0, 1, 2, 3]] AS r FROM d),
k AS (SELECT *, len(u) AS n, least(r[1] % (len(u) + 1), r[2] % (len(u) + 1)) AS one,
             greatest(r[1] % (len(u) + 1), r[2] % (len(u) + 1)) AS two,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 50 THEN 'plain'
                  WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM w),
p AS (SELECT *, coalesce(array_to_string(u[1:one], ''), '') AS a, coalesce(array_to_string(u[one + 1:two], ''), '') AS m,
             coalesce(array_to_string(u[two + 1:], ''), '') AS z FROM k)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(a) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m
              ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
