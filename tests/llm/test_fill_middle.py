"""Fill-in-the-middle: cuts against plain tokenizing, exact round trip, cache."""
import hashlib
import random
import re

from llm_fixtures import docs, empty, frame, rows  # noqa: F401
from sparkfin.llm import fill_middle, queries

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc_id, text):
    text = text or ""
    u = TOKEN.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return len(u), "plain", None, None, text
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h4 % 100 < 80:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def odd_texts(seed=0):
    rng = random.Random(seed)
    words = ["a", "über", "日本語", "x" * 900, " ", "😀", " y", "end."] + [f"w{i}" for i in range(200)]
    blanks = [" ", "  ", "\n", "\t \r\n", " " * 300, "\x0b", "\x0c"]
    passage = "".join(rng.choice(words) + " " for _ in range(900))
    out = ["", " ", "\n\n", "one", " one", "one ", "a b", "x" * 20000, " " * 20000, "ab " * 9000, passage, passage + passage, "<P> in it", "in <S", "é" * 7000]
    for _ in range(150):
        t = "".join(rng.choice(words) + rng.choice(blanks) for _ in range(rng.randint(0, 300)))
        out.append(rng.choice(["", " ", "\n"]) + t + (rng.choice(words) if rng.random() < 0.5 else "") + (passage if rng.random() < 0.3 else ""))
    return out


def test_counts_and_every_cut():
    cache = fill_middle.ContentCache()
    for t in odd_texts():
        raw = t.encode()
        c = fill_middle.Counts(raw, cache)
        u = TOKEN.findall(t)
        assert c.n == len(u)
        for k in {0, 1, 2, len(u) // 3, len(u) // 2, len(u) - 1, len(u)} & set(range(len(u) + 1)):
            head = "".join(u[:k])
            assert c.cut(k) == (len(head.encode()), len(head))


def test_chunks_follow_content():
    rng = random.Random(2)
    shared = " ".join(f"s{rng.randrange(5000)}" for _ in range(4000)).encode()
    cache = fill_middle.ContentCache()
    for i in range(6):
        raw = b"x" * (37 * i) + b" " + shared
        ends = fill_middle.chunk_ends(raw)
        assert ends[-1] == len(raw) and all(0 < b - a <= fill_middle.MOST for a, b in zip([0] + ends, ends))
        fill_middle.Counts(raw, cache)
    # after the first text almost every chunk of the shared passage is known
    assert cache.hits > 4 * 0.8 * cache.misses and cache.hits > 100


def test_cache_is_bounded_and_verified_by_content():
    cache = fill_middle.ContentCache(most=5000)
    rng = random.Random(3)
    for _ in range(400):
        chunk = " ".join(rng.choices("abc", k=rng.randint(1, 60))).encode()
        assert cache.summary(chunk) == fill_middle.summary(chunk)
        assert sum(map(len, cache.kept)) == cache.held <= 5000


def test_query(spark, rows, tmp_path):
    rows = rows + [(1000 + i, t, "en", "s") for i, t in enumerate(odd_texts(5))]
    frame(spark, rows, clash=True).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_fill_in_middle(spark, str(tmp_path)).collect()

    def sha(t):
        return hashlib.sha256((t or "").encode()).hexdigest()
    want = [(r[0], *(e := expected(r[0], r[1]))[:4], sha(e[4]), sha(r[1])) for r in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {g.form for g in got} == {"plain", "spm", "psm"}


def test_outputs_and_edges(spark, docs, empty):
    got = {r.id: r for r in fill_middle.fill_in_middle(docs, rate=100, spm=0).collect()}
    assert got[403].output in ("<P>one<S><M>", "<P><S>one<M>", "<P><S><M>one") and got[400].output == "" and got[400].form == "plain"
    assert fill_middle.fill_in_middle(empty).count() == 0
