"""Top-k inner products, edit matching and license alignment."""
import random

import numpy as np
import pytest

from llm_fixtures import empty, frame  # noqa: F401
from sparkfin.llm import decontaminate, licenses, top_inner


def brute_top(rows, k=5):
    v = [(i, np.floor(256 * np.array(x, np.float64)).astype(np.int64)) for i, x in rows
         if i is not None and x is not None and all(c is not None and np.isfinite(c) for c in x)]
    out = []
    for q, a in v:
        if q % 50 == 0:
            s = sorted((-int((a * b).sum()), i) for i, b in v if i != q)[:k]
            out += [(q, r, i, -x) for r, (x, i) in enumerate(s, 1)]
    return sorted(out)


@pytest.mark.parametrize("d,n", [(3, 300), (64, 400), (1, 60), (8, 4)])
def test_top_inner(spark, d, n):
    rng = np.random.default_rng(d)
    rows = [(i, (rng.normal(size=d) * (0.1 if i % 3 else 2)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[i % n][1]) for i in range(20)]  # ties
    rows += [(None, rows[0][1]), (5001, None), (5002, [None] * d), (5003, [float("nan")] * d), (5050, [float("inf")] * d), (6000, [0.0] * d)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "2 as block", "3 as v", "4 as rank")
    got = top_inner.top_inner(df, lambda i: i % 50 == 0, block=64, query_block=3)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows)


def test_block_pairs_are_left_out_by_length(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=8) * 2.0 ** -(i // 60)).astype(np.float32).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    seen, real = [], top_inner.block_pairs

    def counted(asked, blocks):
        pairs = real(asked, blocks)
        seen.append((pairs.count(), asked.count() * blocks.count()))
        return pairs
    monkeypatch.setattr(top_inner, "block_pairs", counted)
    got = top_inner.top_inner(df, lambda i: i % 50 == 0, block=40, query_block=1)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows)
    assert seen[0][0] * 3 < seen[0][1]


def test_top_inner_empty(spark):
    assert top_inner.top_inner(spark.createDataFrame([], "vec_id long, embedding array<float>"), lambda i: i % 50 == 0).count() == 0


def distance_in(pattern, text):
    """Least edit distance of the pattern to a part of the text, by rows."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        old, row[0] = row[:], i
        for j, b in enumerate(text, 1):
            row[j] = min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (a != b))
    return min(row)


def test_myers():
    rng = random.Random(3)
    for _ in range(60):
        p = "".join(rng.choices("abcd", k=rng.randint(1, 90)))
        t = "".join(rng.choices("abcd", k=rng.randint(0, 120)))
        found, end = decontaminate.myers(len(p), decontaminate.column_masks(p), t)
        assert found == distance_in(p, t) and found == distance_in(p, t[:end])


def test_leaks_match_all_items(spark):
    rng = random.Random(4)
    letters = "abcdefghij "
    items = [(i, "".join(rng.choices(letters, k=rng.randint(40, 300)))) for i in range(12)] + [(50, None), (51, ""), (52, "short"), (53, "x" * 400)]
    rows = []
    for i in range(120):
        t = list(rng.choice(items[:12])[1])
        for _ in range(rng.randint(0, 25)):
            t[rng.randrange(len(t))] = rng.choice(letters)
        rows.append((i, "".join(rng.choices(letters, k=200)) + "  \n" + "".join(t).upper() + "".join(rng.choices(letters, k=100)), "en", "s"))
    rows += [(900, None, "en", "s"), (901, "", "en", "s"), (902, "in shorts", "en", "s"), (903, "a Short one", "en", "s"), (None, items[0][1], "en", "s")]
    tests = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as id", "2 as item")
    want = set()
    for i, t, *_ in rows:
        for j, p in items:
            p, n = decontaminate.normal(p), decontaminate.normal(t)
            k = decontaminate.budget(len(p))
            if p and n and (distance_in(p, n) <= k if k else f" {p} " in f" {n} "):
                want.add((i, j))
    for block in (decontaminate.BLOCK_CHARS, 500):
        got = decontaminate.leaks(frame(spark, rows, clash=True), tests, block_chars=block).collect()
        assert {(r.id, r.item) for r in got} == want and len(got) == len(want)
    text, item = {r[0]: decontaminate.normal(r[1]) for r in rows}, {i: decontaminate.normal(p) for i, p in items}
    assert all(distance_in(item[r.item], text[r.id][r.start:r.end]) == r.distance for r in got if r.distance)


def test_leaks_empty(spark, empty):
    tests = spark.createDataFrame([(1, "some test item of a benchmark")], "item_id long, text string")
    assert decontaminate.leaks(empty, tests).count() == 0
    assert decontaminate.leaks(frame(spark, [(1, "text", "en", "s")]), tests.limit(0)).count() == 0


def test_patience_alignment():
    a, b = "a b c d e f g".split(), "x a c b d e y f g".split()
    pairs = licenses.align(a, b)
    assert [a[i] for i, _ in pairs] == [b[j] for _, j in pairs]
    assert all(p < q and u < v for (p, u), (q, v) in zip(pairs, pairs[1:], strict=False)) and len(pairs) == 6
    assert licenses.align([], b) == [] and licenses.align(a, a) == [(i, i) for i in range(7)]


def test_license_scan(spark):
    mit = " ".join(licenses.TEMPLATES["MIT"].split())
    cut = " ".join(w for i, w in enumerate(mit.split()) if i % 9)
    rows = [(1, "Some code.\n" + mit + "\nMore.", "en", "s"), (2, cut, "en", "s"), (3, " ".join(mit.split()[:30]), "en", "s"), (4, None, "en", "s"), (5, "", "en", "s"),
            (6, "x " * 30000 + "Released under the MIT License. " + "y " * 20000 + "All rights reserved.", "en", "s"), (7, "a license is a permission", "en", "s"),
            (8, "Licensed under the Apache License, Version 2.0.", "en", "s"), (None, "All rights reserved.", "en", "s")]
    got = licenses.scan(frame(spark, rows, clash=True)).collect()
    assert sorted(((r.id, r.license) for r in got), key=str) == sorted(
        [(1, "MIT"), (2, "MIT"), (6, "MIT-notice"), (6, "All-rights-reserved"), (8, "Apache-2.0-notice"), (None, "All-rights-reserved")], key=str)
    assert {r.id: round(r.coverage, 2) for r in got}[1] == 1.0
    assert licenses.scan(frame(spark, [])).count() == 0


def test_license_copies_side_by_side():
    mit = " ".join(licenses.TEMPLATES["MIT"].split())
    scanner, m = licenses.Scanner(licenses.TEMPLATES), len(licenses.words_of(licenses.TEMPLATES["MIT"]))
    for between in (0, 10, 30, 60):
        for copies in (1, 2, 5):
            text = (" " + "and " * between).join([mit] * copies)
            assert [(r[0], r[2], r[3]) for r in scanner.scan(text)] == [("MIT", i * (m + between), i * (m + between) + m) for i in range(copies)]
    words = mit.split()
    first = " ".join(words[:-6])                                            # lacks its end
    second = " ".join(w for i, w in enumerate(words) if i % 11 != 5)
    third = " ".join(x for i, w in enumerate(words) for x in ((w, "zz") if i % 3 == 0 else (w,)))  # more words between
    assert [r[0] for r in scanner.scan(" ".join([first, second, mit, third]))] == ["MIT"] * 4
