"""Near duplicates against all pairs of full sets."""
import re
import random
from itertools import combinations

import numpy as np
import pytest

from llm_fixtures import docs, empty, rows  # noqa: F401
from sparkfin.llm import near_dup
from sparkfin.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def gram_set(text, k):
    w = [x.lower() for x in WORD.findall((text or "").encode())]
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k):
    sets = [(r[0], gram_set(r[1], k)) for r in rows]
    root = {i: i for i, s in sets if i is not None}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for (a, x), (b, y) in combinations([(i, s) for i, s in sets if i is not None and s], 2):
        if 100 * len(x & y) >= 80 * len(x | y):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return sorted(((i, len(s), find(i) if i is not None else None) for i, s in sets), key=str)


@pytest.mark.parametrize("k", [2, 5])
def test_components_match_all_pairs(spark, docs, rows, k):
    got = near_dup.near_duplicates(docs, shingle=k).collect()
    assert sorted(((r.id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, k)
    assert all(r.kept == (r.id == r.component_id or r.id is None) for r in got)


def test_group_of_variants_of_one_text(spark):
    """Most variants are near to the original only, not to each other."""
    rng = random.Random(5)
    words = [f"v{i}" for i in range(150)]
    rows = [(0, " ".join(words), "en", "s")]
    for i in range(1, 150):
        w = list(words)
        for _ in range(rng.randint(1, 9)):
            w[rng.randrange(150)] = f"x{rng.random()}"
        rows.append((1000 - i, " ".join(w), "en", "s"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = near_dup.near_duplicates(df).collect()
    assert sorted(((r.id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 2)


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    table, hits = near_dup.probe_table(), []
    for _ in range(60):
        common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) for n in (40, 5, 5))
        s, t = np.unique(np.append(common, a)), np.unique(np.append(common, b))
        hits.append((near_dup.signature(s, table) == near_dup.signature(t, table)).mean())
    assert abs(np.mean(hits) - 0.8) < 0.03


def test_empty(empty):
    assert near_dup.near_duplicates(empty).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (100, 101)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(40)}}


def test_pair_in_a_family_that_is_not_near(spark):
    """Members share boilerplate at 0.74; one pair is near, but shares no band
    that only the two have."""
    rng, table, c = random.Random(9), near_dup.probe_table(), near_dup.odd_constants(near_dup.ROWS + 1, near_dup.SEED)
    core = [f"c{i}" for i in range(170)]

    def grams(words):
        return near_dup.shingle_set(" ".join(words), 1, c)
    for attempt in range(2000):
        tail = [f"t{attempt}_{j}" for j in range(30)]
        x, y = core + tail, core + tail[:10] + [f"y{attempt}_{j}" for j in range(20)]
        sx, sy = (near_dup.signature(grams(w), table) for w in (x, y))
        same = near_dup.band_keys(sx, c) == near_dup.band_keys(sy, c)
        if same.any() and not np.isin(sx.reshape(-1, near_dup.ROWS)[same], grams(tail[:10])).any():
            break
    rows = [(i, " ".join(core + [f"u{i}_{j}" for j in range(30)]), "en", "s") for i in range(2000)]
    rows += [(5000, " ".join(x), "en", "s"), (5005, " ".join(y), "en", "s")]
    rng.shuffle(rows)
    sets = {r[0]: gram_set(r[1], 1) for r in rows}
    assert len(sets[5000] & sets[5005]) / len(sets[5000] | sets[5005]) > 0.8 > 0.75 > len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.id: r.component_id for r in near_dup.near_duplicates(df, shingle=1).collect()}
    assert got == {i: 5000 if i == 5005 else i for i in sets}


def test_bitmaps_differ_in_no_more_bits_than_the_sets():
    rng = np.random.default_rng(3)
    for _ in range(300):
        common, x, y = (rng.integers(0, 2**63, int(rng.integers(0, n)), dtype=np.uint64) for n in (3000, 400, 400))
        sets = [np.unique(np.append(common, z)) for z in (x, y)]
        a, b = (near_dup.parity_bits(s).view(np.uint64) for s in sets)
        assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(*sets))


def test_family_makes_no_pairs(spark):
    """Members share 70 of 100 words, each other word is one of 6; no pair is
    near, and the finish makes no rows however many members there are."""
    rng, table, c = random.Random(12), near_dup.probe_table(), near_dup.odd_constants(near_dup.ROWS + 1, near_dup.SEED)
    made = []
    for n in (300, 900):
        texts = [" ".join([f"c{i}" for i in range(70)] + [f"v{i}_{rng.randrange(6)}" for i in range(30)]) for _ in range(n)]
        sets = [near_dup.shingle_set(t, 1, c) for t in texts]
        keys = [(k, i, len(s), i) for i, s in enumerate(sets) for k in near_dup.band_keys(near_dup.signature(s, table), c).view(np.int64).tolist()]
        live = spark.createDataFrame(keys, "key long, node long, n long, root long")
        bits = spark.createDataFrame([(i, near_dup.parity_bits(s).tolist()) for i, s in enumerate(sets)], "id long, bits array<long>")
        made.append(near_dup.unsettled_pairs(live, bits).count())
    assert made[0] <= 300 // 50 and made[1] <= 900 // 50, made
