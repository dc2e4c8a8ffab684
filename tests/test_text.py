"""Text chain on edge inputs, phrases against a brute-force scan, stemmer."""
import numpy as np
from pyspark.sql import functions as F

from porter_by_hand import stem
from sparkfin.operators import text as T
from sparkfin.operators import word_vectors as V

CSCHEMA = ("sub string, sub_date date, comment_index_track long, position long, kind string, author string, "
           "comment string, comment_upvotes int")


def _comments(spark, texts):
    import datetime as dt
    rows = [("t", dt.date(2024, 1, 1), i, 0, "comment", "u", t, 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, CSCHEMA)


def test_edge_tokens(spark):
    c = _comments(spark, ["BTC don't moon!", "digits 123 and 4ever", "BTC don't moon!", "one", "red red red"])
    sym = spark.createDataFrame([("BTC", "bitcoin"), ("red", "brandb")], "symbol string, name_lower string")
    s = {r.cid: r.tokens for r in T.sentences(c, sym).collect()}
    assert len(s) == 4                                   # exact duplicate removed
    assert s["0:0"] == ["bitcoin", "moon"]               # contraction expanded, stop words gone
    assert s["1:0"] == ["digits"]                        # digits, mixed tokens and stop words removed
    assert s["4:0"] == ["brandb", "brandb", "brandb"]    # symbols replaced before lower-casing


def test_ngram_interleave(spark):
    df = spark.createDataFrame([("a", ["w1", "w2", "w3"])], "cid string, tokens array<string>")
    r = T.ngram_sentences(df).first()
    assert r.gram2 == ["w1", "w1_w2", "w2", "w2_w3", "w3"]
    assert r.gram3 == ["w1", "w1_w2_w3", "w2", "w3"]
    assert r.gram4 == ["w1", "w2", "w3"]


def _brute_phrases(sents, min_count=3, threshold=10.0):
    from collections import Counter
    na, nab = Counter(), Counter()
    for s in sents:
        na.update(s)
        nab.update(zip(s, s[1:]))
    V = len(na) + len(nab)
    good = {p for p, n in nab.items() if (n - min_count) / na[p[0]] / na[p[1]] * V > threshold}
    out = []
    for s in sents:
        res, i = [], 0
        while i < len(s):
            if i + 1 < len(s) and (s[i], s[i + 1]) in good:
                res.append(s[i] + "_" + s[i + 1])
                i += 2
            else:
                res.append(s[i])
                i += 1
        out.append(res)
    return out


def test_phrases_match_brute_force(spark):
    import random
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    sents = []
    for _ in range(300):
        s = [rnd.choice(words) for _ in range(rnd.randint(0, 12))]
        if rnd.random() < 0.5:
            k = rnd.randint(0, len(s))
            s[k:k] = ["new", "york", "york", "new", "york"]
        sents.append(s)
    df = spark.createDataFrame([(str(i), s) for i, s in enumerate(sents)], "cid string, tokens array<string>")
    got = {r.cid: r.tokens for r in T.phrases(df).collect()}
    want = _brute_phrases(sents)
    assert all(got[str(i)] == want[i] for i in range(len(sents)))


def _stems(spark, words):
    from sparkfin.functions.porter import stem_table
    table = stem_table(spark.createDataFrame([(w,) for w in words], "word string"))
    assert "Python" not in table._jdf.queryExecution().executedPlan().toString()
    return {r.word: r.stem for r in table.collect()}


def test_stem_columns_equal_the_rules_word_by_word(spark):
    import itertools
    import random
    from sparkfin.functions.porter import STEP2, STEP3, STEP4
    rng = random.Random(3)
    ends = ["", "s", "sses", "ies", "eed", "ed", "ing", "y", "ied", "ll", "e", "ated", "izing", *STEP2, *STEP3, *STEP4]
    heads = ["", "y", "yy", "ayyy", "tyyyy", "gr", "hop", "fil", "add", "control", "nation", "ärg", "fizz", "x", "snow"]
    heads += ["".join(rng.choice("abeilnosty") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    words = {h + e for h, e in itertools.product(heads, ends)} | {"y" * k for k in range(1, 9)} | {"yay" * 4000}
    got = _stems(spark, sorted(words))
    assert {w: stem(w) for w in words} == got


def test_stems_of_null_and_no_words(spark):
    from sparkfin.functions.porter import stem_table
    empty = spark.createDataFrame([(None,)], "word string")
    assert [tuple(r) for r in stem_table(empty).collect()] == [(None, None)]
    assert stem_table(empty.limit(0)).count() == 0


def test_stemmer_known_words(spark):
    pairs = {"caresses": "caress", "ponies": "poni", "motoring": "motor", "relational": "relat",
             "generalizations": "gener", "hopping": "hop", "filing": "file", "happy": "happi"}
    assert {w: stem(w) for w in pairs} == pairs == _stems(spark, pairs)


def test_word_frequency_sums_tokens(spark):
    df = spark.createDataFrame([("a", ["x", "y", "x"]), ("b", ["x"])], "cid string, tokens array<string>")
    got = {r.word: r.n for r in T.word_frequency(df).collect()}
    assert got == {"x": 3, "y": 1}
    assert T.word_frequency(df).agg(F.sum("n")).first()[0] == 4


def test_words_seen_once_have_vectors(spark):
    s = spark.createDataFrame([(1, ["a", "b", "a", "once"]), (2, ["b", "a"]), (3, ["alone", "single"])], "cid long, tokens array<string>")
    for block_words in (100, 2):  # one block, and several that may be empty
        v = V.skip_gram(s, dim=4, epochs=2, block_words=block_words).collect()
        assert {r.word: len(r.vector) for r in v} == dict.fromkeys(["a", "b", "once", "alone", "single"], 4)
    assert V.skip_gram(s, dim=4, epochs=1, min_count=2).count() == 2


def _planted(spark):
    """Sentences about two topics; "left" and "port" are one word with two names."""
    rng = __import__("random").Random(5)
    topics = [[f"t{k}w{i}" for i in range(6)] for k in range(8)]
    names = [("left", "port"), ("right", "star")]
    rows = []
    for i in range(1500):
        k = i % 8
        words = rng.choices(topics[k], k=8)
        if k < 2:
            words[rng.randrange(1, 7)] = rng.choice(names[k])
        rows.append((i, words))
    return spark.createDataFrame(rows, "cid long, tokens array<string>")


def test_planted_synonyms_are_nearest(spark):
    s = _planted(spark)
    for block_words in (1000, 20):
        v = V.skip_gram(s, dim=16, sample=1.0, rate=0.05, negative=5, epochs=20, visits=4, block_words=block_words).cache()
        near = {(r.word, r.similar) for r in T.similar_words(v, ["left", "star"], n=3).collect()}
        assert ("left", "port") in near and ("star", "right") in near


def test_vectors_are_written_once_a_visit_however_many_blocks(spark, monkeypatch):
    made, folder = [], V._folder
    monkeypatch.setattr(V, "_folder", lambda *a: made.append(folder(*a)) or made[-1])
    s = spark.createDataFrame([(i, [f"w{i}", f"w{i + 1}", "all"]) for i in range(40)], "cid long, tokens array<string>")
    v = V.skip_gram(s, dim=4, sample=1e9, epochs=2, visits=2, block_words=6)
    assert len(made) == 2  # before: one folder for each visit and block
    assert {r.word: len(r.vector) for r in v.collect()} == dict.fromkeys([f"w{i}" for i in range(41)] + ["all"], 4)
    copies = spark.read.parquet(made[-1])  # a word's copies are the parts its documents are in
    assert copies.count() <= 3 * 40 and copies.filter("copies = 1").count() > 0
    assert copies.groupBy("id").agg(F.count("*").alias("k"), F.max("copies").alias("c")).filter("k <> c").count() == 0


def test_copies_are_averaged_by_their_pairs_across_batches():
    import numpy as np
    import pyarrow as pa
    ids, w = [1, 1, 1, 2, 3, 3], [1, 2, 1, 5, 1, 3]
    m = np.arange(12, dtype=np.float32).reshape(6, 2)
    table = pa.table({"part": pa.array(range(6), pa.int32()), "id": pa.array(ids), "n": pa.array(w), "copies": pa.array(w, pa.int32()), "w": pa.array(w),
                      "m": pa.array([x.tobytes() for x in m], pa.binary())})
    want = np.array([np.average(m[np.array(ids) == i], axis=0, weights=np.array(w)[np.array(ids) == i]) for i in ids])
    for size in (1, 2, 3, 6):
        got = pa.Table.from_batches(V._averaged(table.to_batches(max_chunksize=size)))
        assert got.column("id").to_pylist() == ids and np.allclose(V._vectors(got.column("m")), want)


def test_frequent_words_are_sub_sampled_and_windows_kept(spark):
    s = spark.createDataFrame([(i, ["the"] * 20 + [f"u{i}", f"v{i}"]) for i in range(100)], "cid long, tokens array<string>")
    vocab, blocks, total = V.vocabulary(s.select(F.explode("tokens").alias("word")))
    assert (blocks, total) == (1, 2200)
    slots = {r.slot: r.word for r in vocab.collect()}
    pairs = [(slots[r.islot], slots[r.oslot]) for r in V.training_pairs(s, vocab, total, 3, 1e-2, 1).collect()]
    assert sum(a == "the" for a, _ in pairs) < 0.7 * len(pairs)  # nine tenths of all tokens
    both = V.training_pairs(s, vocab, total, 1, 1e9, 1).count()
    assert both == 2 * 100 * 21


def test_saved_vectors_are_loaded_for_the_same_corpus(spark):
    s = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["b", "a"])], "cid long, tokens array<string>")
    first = V.saved_or_trained(s, dim=4, epochs=1)
    again = V.saved_or_trained(s.orderBy("cid"), dim=4, epochs=1)
    other = V.saved_or_trained(s.filter("cid = 1"), dim=4, epochs=1)
    assert first.inputFiles() == again.inputFiles() and first.inputFiles() != other.inputFiles()


def test_clusters_keep_the_best_start(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.linalg import Vectors
    rng = __import__("random").Random(4)
    points = [[10.0 * (i % 7) + rng.random(), 7.0 * (i % 5) + rng.random()] for i in range(140)]
    v = spark.createDataFrame([(f"w{i}", p) for i, p in enumerate(points)], "word string, vector array<float>")
    m = spark.createDataFrame([(Vectors.dense(p),) for p in points], ["vector"])
    costs = [KMeans(k=10, seed=1 + i, maxIter=10_000, featuresCol="vector").fit(m).summary.trainingCost for i in range(6)]
    centres, best = T.best_kmeans(v, 10, starts=100)
    assert centres.shape == (10, 2) and best <= min(costs) * (1 + 1e-3) and best < max(costs)
    near = ((np.array(points)[:, None, :] - centres) ** 2).sum(axis=2).min(axis=1).sum()
    assert abs(near - best) < 0.01 * best


def test_comment_authors_without_an_account_or_thread(spark):
    comments = spark.createDataFrame(
        [("t1", 1, 0, "ann", "hi"), ("t1", 1, 1, "bob", "ho"), ("t9", 2, 0, "ann", "x"), ("t1", 3, 0, "gone", "y"),
         ("t1", 4, 0, "[deleted]", "z"), ("t1", 5, 0, None, "n")],
        "sub string, comment_index_track long, position long, author string, comment string")
    authors = spark.createDataFrame([("ann", 7), ("bob", 8), ("[deleted]", 9)], "author string, karma int")
    threads = spark.createDataFrame([("t1", 50)], "sub string, sub_upvotes int")
    got = {(r.comment_index_track, r.position): (r.author, r.parent_author, r.karma, r.sub_upvotes)
           for r in T.comment_authors(comments, authors, threads).collect()}
    assert got == {(1, 0): ("ann", None, 7, 50), (1, 1): ("bob", "ann", 8, 50), (2, 0): ("ann", None, 7, None)}
    assert T.comment_authors(comments.limit(0), authors, threads).count() == 0


def test_copies_of_a_comment_keep_the_first_key_and_are_read_once(spark):
    import datetime as dt
    day = [dt.date(2024, 1, d) for d in (1, 2)]
    rows = [("t1", day[0], 5, 0, "same"), ("t2", day[1], 7, 1, "same"), ("t2", day[1], 7, 0, "same"),
            ("t1", day[0], 1, 0, None), ("t1", day[0], 0, 0, None), ("t1", day[0], 2, 0, ""), ("t1", day[0], 3, 0, "other")]
    df = spark.createDataFrame(rows, "sub string, sub_date date, comment_index_track long, position long, comment string")
    got = T.dedup_comments(df)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("7:0", "same"), ("0:0", None), ("2:0", ""), ("3:0", "other")], key=str)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 1
    assert T.dedup_comments(df.limit(0)).count() == 0
    symbols = spark.createDataFrame([("other", "renamed")], "symbol string, name_lower string")
    by_rows = {r.word: r.n for r in T.comment_word_frequency(df, symbols).collect()}
    assert by_rows == {r.word: r.n for r in T.word_frequency(T.sentences(df, symbols)).collect()} == {"renamed": 1}


def test_documents_of_one_key_repeated_symbols_and_no_text(spark):
    """Two texts under one key are merged by position; a symbol named twice
    gives both names; a null text is no document, a blank one has no tokens."""
    clean = spark.createDataFrame([("a", "BTC up"), ("a", "an ETH now"), ("b", "x BTC"), ("c", None), ("d", " "), ("e", "")], "cid string, clean string")
    sym = spark.createDataFrame([("BTC", "bit"), ("BTC", "Coin"), ("ETH", None), (None, "no")], "symbol string, name_lower string")
    got = {r.cid: r.tokens for r in T.symbol_replace(clean, sym).collect()}
    assert got == {"a": ["Coin", "an", "bit", "ETH", "up", "now"], "b": ["x", "Coin", "bit"], "d": [], "e": []}
    low = {r.cid: r.tokens for r in T.tokens_from_clean(clean, sym).collect()}
    assert low == {"a": ["an", "bit", "coin", "eth", "up", "now"], "b": ["x", "bit", "coin"], "d": [], "e": []}


def _token_exchanges(df):
    """Exchanges that deal out one row per token, in the plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return [line for line in final.splitlines() if "Exchange hashpartitioning" in line and ("pos#" in line or "tok#" in line)]


def test_tokens_are_not_dealt_out_for_symbols(spark):
    c = _comments(spark, [f"word{i} BTC and more words {i}" for i in range(50)])
    sym = spark.createDataFrame([("BTC", "bitcoin")], "symbol string, name_lower string")
    assert not _token_exchanges(T.sentences(c, sym))


def test_phrases_in_one_long_run_and_threshold_below_zero(spark):
    sents = [["new", "york"] * 6 + ["new"]] * 6 + [[], ["other"], ["york", "new"]]
    df = spark.createDataFrame([(str(i), s) for i, s in enumerate(sents)], "cid string, tokens array<string>")
    for threshold in (0.0, -10.0):
        got = {r.cid: r.tokens for r in T.phrases(df, 3, threshold).collect()}
        want = _brute_phrases(sents, 3, threshold)
        assert [got[str(i)] for i in range(len(sents))] == want


def test_documents_are_moved_as_text_not_as_tokens(spark):
    clean = spark.createDataFrame([("a", "Btc goes up"), ("a", "x BTC"), ("b", ""), ("c", None)], "cid string, clean string")
    symbols = spark.createDataFrame([("BTC", "bitcoin"), ("up", None)], "symbol string, name_lower string")
    got = T.symbol_replace(clean, symbols)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(clean" in plan and "collect_list(split" not in plan
    assert {r.cid: sorted(r.tokens) for r in got.collect()} == {"a": ["Btc", "bitcoin", "goes", "up", "x"], "b": []}
