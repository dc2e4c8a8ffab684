"""Repeated windows against a dictionary of all windows."""
import hashlib
import random
import re

import pytest

from llm_fixtures import docs, empty, frame, rows  # noqa: F401
from sparkfin.llm.substring_dedup import substring_dedup

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, window=20):
    texts = sorted({(r[0], r[1]) for r in rows if r[1]}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for i, t in texts:
        w = WORD.findall(t.encode())
        gone = set()
        for p in range(len(w) - window + 1):
            win = tuple(w[p:p + window])
            if win in seen:
                gone.update(range(p, p + window))
            seen.add(win)
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out[i, t] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    nothing = (0, 0, hashlib.sha256(b"").hexdigest())
    return sorted(((r[0], *out.get((r[0], r[1]), nothing)) for r in rows), key=str)


def got(df):
    return sorted(((r.id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(df).collect()), key=str)


def test_matches_all_windows(docs, rows):
    assert got(docs) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_few_words_many_repeats(spark, seed):
    """A small vocabulary: stretches meet in many ways, also inside one text."""
    rng = random.Random(seed)
    pool = [[rng.choice("abc") for _ in range(rng.randint(15, 60))] for _ in range(12)]
    rows = []
    for i in range(60):
        w = sum((rng.choice(pool)[rng.randint(0, 5):] for _ in range(rng.randint(1, 5))), [])
        rows.append((rng.randint(0, 10**6) * 100 + i, " ".join(w), "en", "s"))
    assert got(frame(spark, rows)) == brute(rows)


def test_id_with_two_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a, "en", "s"), (1, b, "en", "s"), (2, a + " " + b, "en", "s")]
    out = got(frame(spark, rows))
    assert [r[2] for r in out] == [0, 0, 80]


def test_empty(empty):
    assert substring_dedup(empty).count() == 0


def test_kept_text(spark):
    a = " ".join(f"a{i}" for i in range(30))
    rows = [(1, a.replace(" ", "\n"), "en", "s"), (2, "x " + a + " y", "en", "s"), (3, None, "en", "s")]
    out = {r.id: r.kept_text for r in substring_dedup(frame(spark, rows)).collect()}
    assert out == {1: a.replace(" ", "\n"), 2: "x y", 3: None}
