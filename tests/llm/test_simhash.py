"""SimHash groups against all pairs of fingerprints."""
import random
from itertools import combinations, product

import pytest
import xxhash

from llm_fixtures import docs, empty, frame, rows  # noqa: F401
from sparkfin.llm import queries, simhash


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(items):
    """items: (id, fingerprint); smallest id reachable of every item."""
    up = {i: i for i, _ in items}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a
    first = {}
    for i, f in items:
        a, b = find(i), find(first.setdefault(f, i))
        up[max(a, b)] = min(a, b)
    for f, g in combinations(first, 2):
        if (f ^ g).bit_count() <= 3:
            a, b = find(first[f]), find(first[g])
            up[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in items}


def test_query_against_all_pairs(spark, rows, tmp_path):
    rng = random.Random(4)
    base = [f"v{i}" for i in range(600)]
    for i in range(200):  # near copies whose fingerprints differ in a few bits
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(600)] = f"x{rng.random()}"
        rows = rows + [(2000 - i, " ".join(w), "en", "s")]
    frame(spark, rows, clash=True).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_simhash(spark, str(tmp_path)).collect()
    root = roots([(r[0], plain_fingerprint(r[1])) for r in rows if r[0] is not None])
    want = [(r[0], f"{plain_fingerprint(r[1]):016x}", root.get(r[0])) for r in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    sizes = [sum(v == i for v in root.values()) for i in set(root.values())]
    assert len(sizes) > 30 and max(sizes) > 20


def test_chain_holds_for_every_small_difference():
    """Of any split of 3 differing bits over the ring, some segment starts a
    chain within its budgets."""
    for b in product(range(4), repeat=4):
        if sum(b) <= 3:
            assert any(all(sum(b[(i + j) % 4] for j in range(n)) <= 3 * n // 4 for n in range(1, 5)) for i in range(4))


@pytest.mark.parametrize("hot", [0, 3, 1024])
def test_links_keep_all_components(spark, hot):
    """Dense families around common centers, paired or met in the middle."""
    rng = random.Random(7)
    prints = {0, (1 << 64) - 1}
    for center in [rng.getrandbits(64) for _ in range(6)]:
        for _ in range(40):
            f = center
            for b in rng.sample(range(64), rng.randint(0, 5)):
                f ^= 1 << b
            prints.add(f)
        block = center ^ rng.getrandbits(64) & 0xFFFF << 16
        prints |= {block ^ x << 40 for x in rng.sample(range(1 << 12), 60)}
    signed = {f: f - (1 << 64) if f >> 63 else f for f in prints}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    found = simhash.links(df, hot).collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 3 for r in found)
    near = {(a, b) for a, b in combinations(sorted(signed.values()), 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    if hot == 1024:
        assert {(min(r.a, r.b), max(r.a, r.b)) for r in found} == near

    def closed(pairs):
        up = {s: s for s in signed.values()}

        def find(a):
            while up[a] != a:
                a = up[a]
            return a
        for a, b in pairs:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
        return {a: find(a) for a in up}
    assert closed((r.a, r.b) for r in found) == closed(near)


def test_members_of_a_hot_key_that_are_not_near(spark):
    rng = random.Random(8)
    family = {rng.getrandbits(32) << 32 | 0xABCD1234 for _ in range(400)}
    assert not any((a ^ b).bit_count() <= 3 for a, b in combinations(family, 2))
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in family]
    assert simhash.links(spark.createDataFrame(signed, "fp long"), hot=100).count() == 0


def test_edges(spark, docs, empty):
    got = {(r.id, r.fp): r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert got[400, 0] == got[401, 0] == got[402, 0] == 400
    assert [c for (i, _), c in got.items() if i is None] == [None]
    assert simhash.near_duplicates(empty).count() == 0


def test_an_id_with_two_texts_is_one_document(spark):
    rows = [(1, "a b c d", "en", "s"), (5, "a b c d", "en", "s"), (5, "p q r s t", "en", "s"), (9, "p q r s t", "en", "s"), (10, "z", "en", "s")]
    got = {r.id: r.component_id for r in simhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == {1: 1, 5: 1, 9: 1, 10: 10}
