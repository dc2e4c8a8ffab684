"""Periodic runs against a search over every period."""
import hashlib
import random
import zlib

import numpy as np
import pytest

from llm_fixtures import docs, empty, frame, rows  # noqa: F401
from sparkfin.llm import periodic, queries
from sparkfin.llm.periodic import Suffixes, WaveletTree

BLANKS = " \t\n\x0b\x0c\r"


def split(text):
    return (text or "").encode().split()


def brute_runs(w):
    """Maximal stretches of every period; a stretch keeps its smallest."""
    n, best = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                best.setdefault((i, j + q), q)
            i = j
    return sorted((s, e, q) for (s, e), q in best.items())


def ours(w):
    return sorted(map(tuple, periodic.group_runs([w])[0].tolist()))


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


@pytest.mark.parametrize("seed", range(12))
def test_random_and_periodic_words(seed):
    rng = random.Random(seed)
    for _ in range(60):
        letters = [b"a", b"b", b"c", b"d"][:rng.randint(1, 4)]
        w = []
        for _ in range(rng.randint(1, 6)):
            unit = rng.choices(letters, k=rng.randint(1, 30))
            if rng.random() < 0.5:  # a unit that is nearly periodic itself
                unit = [rng.choice(letters)] * rng.randint(1, 14) + unit[:rng.randint(1, 6)]
            whole = unit * rng.randint(1, 8)
            w += whole[:len(whole) - rng.randint(0, len(unit) - 1)]
            w += rng.choices(letters, k=rng.randint(0, 3))
        assert ours(w) == brute_runs(w)


def test_words_with_structure():
    for w in (fibonacci(400), list("a" * 300), list("ab" * 200 + "c" + "ab" * 200), list(("a" * 10 + "bcdef") * 3), list(("a" * 15 + "b") * 9),
              list(("aab" * 7 + "c") * 5), list("abcdefgh" * 3), list("abcdefgh" * 2 + "abcdefg"), [], list("a" * 23), list("a" * 24)):
        w = [x.encode() for x in w]
        assert ours(w) == brute_runs(w), b"".join(w)


def test_documents_are_searched_apart():
    rng = random.Random(3)
    many = [[rng.choice([b"x", b"y"]) for _ in range(rng.randint(0, 80))] * rng.randint(1, 4) for _ in range(80)]
    many += [many[5], many[5], [], [b"x"] * 30, [b"x"] * 30]
    got = periodic.group_runs(many)
    assert [sorted(map(tuple, g.tolist())) for g in got] == [brute_runs(w) for w in many]


def test_range_successor():
    rng = np.random.default_rng(2)
    a = rng.permutation(500)
    tree = WaveletTree(a)
    lo = rng.integers(0, 500, 400)
    hi = np.minimum(500, lo + rng.integers(0, 60, 400))
    x = rng.integers(0, 600, 400)
    want = [min([v for v in a[i:j] if v >= y], default=periodic.NONE) for i, j, y in zip(lo, hi, x)]
    assert tree.successor(lo, hi, x).tolist() == want


def test_agreement_both_ways():
    rng = np.random.default_rng(4)
    a = np.tile(rng.integers(0, 3, 40), 6)
    a[100] = 7
    s = Suffixes(a, 5)
    for i, j in rng.integers(0, len(a), (300, 2)):
        i, j = min(i, j), max(i, j)
        if i == j:
            continue
        right = next((k for k in range(len(a) - j) if a[i + k] != a[j + k]), len(a) - j)
        left = next((k for k in range(i) if a[i - 1 - k] != a[j - 1 - k]), i)
        assert s.agree(np.array([i]), np.array([j]))[0] == right
        assert s.agree(np.array([i]), np.array([j]), left=True)[0] == left


def expected(doc_id, text):
    w = split(text)
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    best = None
    for s, e, q in sorted(runs, key=lambda r: (r[0], r[2])):
        if best is None or (e - s) * best[2] > best[1] * q:
            best = (s, e - s, q)
    text = "".join(f"{s},{e - s},{q}\n" for s, e, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_against_every_period(spark, rows, tmp_path):
    rows = [r for r in rows if len(split(r[1])) < 2000]
    rows += [(500 + i, " ".join(f"w{i} w{i + 1} {'x ' * (i % 4)}".split() * (2 + i)), "en", "s") for i in range(40)]
    rows += [(600, "\x0b".join(["ß", "日本"] * 20) + BLANKS, "en", "s"), (601, "a" + BLANKS + "a", "en", "s")]
    frame(spark, rows, clash=True).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == sorted((expected(r[0], r[1]) for r in rows), key=str)


def test_a_very_long_text_and_edges(spark, docs, empty):
    got = {r.id: r for r in periodic.periodic_runs(docs).collect()}
    assert [(r.start, r.length, r.period) for r in got[407].runs] == [(0, 300, 1)] and got[407].collapsed == "same"
    assert got[400].runs == got[401].runs == [] and got[400].collapsed == got[402].collapsed == ""
    assert periodic.periodic_runs(empty).count() == 0
    rng = random.Random(1)
    long = rng.choices([f"w{i}" for i in range(50)], k=60000)
    long[20000:50000] = [f"u{i % 700}" for i in range(30000)]
    runs = periodic.group_runs([[x.encode() for x in long]])[0]
    assert (20000, 50000, 700) in set(map(tuple, runs.tolist()))
