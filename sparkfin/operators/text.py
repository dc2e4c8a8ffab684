"""Forum text: cleaning, tokens, n-grams, collocation phrases, word vectors.

Documents are processed whole.  Per-document work is array expressions on
the row (JVM-side, no shuffle); corpus statistics (word and pair counts) are
``groupBy`` aggregations with map-side combining, so hot words are
pre-aggregated before any shuffle.  Where tokens are exploded for a join,
the regrouping is keyed by document and holds at most one document's tokens.
"""
from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import CONTRACTIONS, STOPWORDS_EN
from ..functions.porter import stem_table
from ..session import ensure_checkpoint_dir, written
from .word_vectors import best_kmeans

WS = r"[ \t\n\f\r]+"
PUNCT = r"[^\p{L}\p{N}_ \t\n\f\r]"


# ---------------------------------------------------------------- threads
def moderator_threads(subs: DataFrame) -> DataFrame:
    s = subs.filter(F.col("title").contains("Daily Discussion -") & F.col("author").contains("AutoModerator"))
    return s.withColumn("day", F.to_date(F.date_trunc("day", "created_utc")))


def merge_last(first: DataFrame, second: DataFrame, key: str, value: str) -> DataFrame:
    """Two key -> value tables as one; where both hold a key the second wins."""
    both = first.select(key, value, F.lit(0).alias("_o")).unionByName(second.select(key, value, F.lit(1).alias("_o")))
    return both.groupBy(key).agg(F.max_by(value, "_o").alias(value))


def daily_thread_ids(subs: DataFrame) -> DataFrame:
    """First moderator 'Daily Discussion' thread of each day."""
    s = moderator_threads(subs)
    w = Window.partitionBy("day").orderBy("created_utc", "id")
    return s.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select("day", "id", "title")


def comments_flat(comments: DataFrame) -> DataFrame:
    """Comments and their replies as one table with their text and author
    fields, replies tagged with the parent comment's author; deleted or missing
    authors removed."""
    top = comments.filter(F.col("position") == 0).select(
        "comment_index_track", F.col("author").alias("parent_author"))
    c = comments.filter(F.col("author").isNotNull() & (F.col("author") != "[deleted]"))
    flat = c.join(top, "comment_index_track", "left")
    return flat.withColumn("parent_author", F.when(F.col("position") > 0, F.col("parent_author"))) \
        .select(*comments.columns, "parent_author")


def comment_authors(comments: DataFrame, authors: DataFrame, threads: DataFrame) -> DataFrame:
    """The flat comments with the account fields of their author and the votes
    of their thread.  A comment whose author has no account any more goes; one
    of an unknown thread stays with empty thread fields.  Both tables have one
    row a key, so a key that holds a third of the comments makes no more rows;
    how the sides meet is left to the planner, which splits a hot key's rows."""
    flat = comments_flat(comments)
    return flat.join(authors, "author").join(threads, "sub", "left").select(
        *flat.columns, *[c for c in authors.columns if c != "author"], *[c for c in threads.columns if c != "sub"])


# ---------------------------------------------------------------- cleaning
def dedup_comments(comments: DataFrame) -> DataFrame:
    """(cid, comment): exact duplicates of the comment text removed, keeping
    the key of the first under an explicit total order (newest thread first,
    then thread, index, position).  One grouped pass over one scan: the group
    key is a digest of the text, copies meet before the shuffle, and the text
    that travels with the digest is any of the group's, which are all equal."""
    keyed = comments.withColumn("_h", F.coalesce(F.sha2("comment", 256), F.lit("null"))) \
        .withColumn("_newest", F.datediff(F.lit("9999-12-31").cast("date"), "sub_date"))
    order = F.struct("_newest", "sub", "comment_index_track", "position")
    first = keyed.groupBy("_h").agg(F.min(order).alias("r"), F.any_value("comment").alias("comment"))
    return first.select(F.concat_ws(":", F.col("r.comment_index_track").cast("string"), F.col("r.position").cast("string")).alias("cid"), "comment")


def _contraction_map():
    return F.create_map(*[F.lit(x) for kv in CONTRACTIONS.items() for x in kv])


def clean_text(comments: DataFrame) -> DataFrame:
    """Dedup, whole-token contraction expansion, punctuation to blanks."""
    d = dedup_comments(comments)
    m = _contraction_map()
    toks = F.transform(F.split("comment", WS), lambda t: F.coalesce(F.try_element_at(m, F.lower(t)), t))
    return d.select("cid", F.regexp_replace(F.array_join(toks, " "), PUNCT, " ").alias("clean"))


def _token_rows(clean: DataFrame, symbols: DataFrame) -> DataFrame:
    """One row per token: (cid, pos, sym, low, keep_any, keep_alpha, keep_stop).

    Every per-token step is a compiled expression on a row (no lambdas): the
    symbol dictionary is a join the planner picks by the sizes it sees,
    alphabetic tokens are a regex match, stop words an ``IN`` list that Spark
    turns into a hash set."""
    toks = clean.select("cid", F.posexplode(F.split("clean", WS)).alias("pos", "tok"))
    sym = symbols.select(F.col("symbol").alias("tok"), "name_lower")
    j = toks.join(sym, "tok", "left").select("cid", "pos", F.coalesce("name_lower", "tok").alias("sym"))
    low = F.lower("sym")
    alpha = low.rlike(r"^\p{L}+$")
    return j.select("cid", "pos", "sym", low.alias("low"), (F.col("sym") != "").alias("keep_any"), alpha.alias("keep_alpha"),
                    (alpha & ~low.isin(*STOPWORDS_EN)).alias("keep_stop"))


def _documents(clean: DataFrame, symbols: DataFrame, keep, value=lambda s: s) -> DataFrame:
    """(cid, tokens): each document's tokens with symbols replaced, as ``value``
    makes them, where ``keep`` holds, in position order.

    Documents stay whole: what is joined and moved for the symbols is only the
    symbols a document holds, each once, as a small map beside its text.  A
    text moves once, to the others of its key (mostly none); their tokens are
    merged by position.  The symbol table is written, so that the planner knows
    its size before any token is dealt out."""
    name = F.coalesce("name_lower", "symbol")
    names = written(symbols.filter(F.col("symbol").isNotNull()).groupBy("symbol").agg(
        F.sort_array(F.transform(F.collect_list(name), value)).alias("names")))
    # moved and sorted as text, which is several times smaller than its tokens
    docs = clean.filter(F.col("clean").isNotNull()).groupBy("cid").agg(F.collect_list("clean").alias("texts"))
    parted = F.transform("texts", lambda t: F.split(t, WS))
    held = docs.select("cid", F.explode(F.array_distinct(F.flatten(parted))).alias("symbol")).join(names, "symbol")
    held = held.groupBy("cid").agg(F.map_from_entries(F.collect_list(F.struct("symbol", "names"))).alias("names"))

    def replaced(t):
        return F.coalesce(F.try_element_at("names", t), F.array(value(t)))

    def placed(text):
        return F.flatten(F.transform(text, lambda t, i: F.transform(replaced(t), lambda s: F.struct(i.alias("pos"), s.alias("t")))))
    first = F.split(F.col("texts")[0], WS)
    one = F.when(F.col("names").isNull(), F.transform(first, value)).otherwise(F.flatten(F.transform(first, replaced)))
    many = F.transform(F.sort_array(F.flatten(F.transform(parted, placed))), lambda x: x["t"])
    return docs.join(held, "cid", "left").select(
        "cid", F.filter(F.when(F.size("texts") == 1, one).otherwise(many), keep).alias("tokens"))


def _alphabetic(low):
    return low.rlike(r"^\p{L}+$")


def symbol_replace(clean: DataFrame, symbols: DataFrame) -> DataFrame:
    """Tokens replaced through the symbol dictionary, in position order."""
    return _documents(clean, symbols, lambda s: s != "")


def tokens_from_clean(clean: DataFrame, symbols: DataFrame) -> DataFrame:
    """Symbols replaced, lower case, alphabetic tokens only."""
    return _documents(clean, symbols, _alphabetic, F.lower)


def sentences(comments: DataFrame, symbols: DataFrame) -> DataFrame:
    """Full cleaning chain (clean, symbols, lower case, alphabetic, stop words)."""
    return _documents(clean_text(comments), symbols, lambda s: _alphabetic(s) & ~s.isin(*STOPWORDS_EN), F.lower)


def tokens(replaced: DataFrame) -> DataFrame:
    """Lower case, alphabetic tokens only (on already grouped tokens)."""
    return replaced.select("cid", F.filter(F.transform("tokens", lambda t: F.lower(t)),
                                           lambda t: t.rlike(r"^\p{L}+$")).alias("tokens"))


def remove_stopwords(toks: DataFrame) -> DataFrame:
    """Stop words removed with the built-in remover (hash-set lookup)."""
    from pyspark.ml.feature import StopWordsRemover
    r = StopWordsRemover(inputCol="tokens", outputCol="_kept", stopWords=STOPWORDS_EN, caseSensitive=True)
    return r.transform(toks).select("cid", F.col("_kept").alias("tokens"))


# ---------------------------------------------------------------- stems
def stems(sents: DataFrame) -> DataFrame:
    """Stem the distinct vocabulary once (column expressions), then map every
    token through the stem table and regroup by document.  The sentences are
    written once: the vocabulary and the documents read them; the stems too, so
    that their size is known before any token is dealt out to meet them."""
    ex = written(sents).select("cid", F.posexplode_outer("tokens").alias("pos", "word"))
    vocab = written(stem_table(ex.select("word").filter("word is not null").distinct()))
    j = ex.join(vocab, "word", "left")
    one = F.when(F.col("stem").isNotNull(), F.struct("pos", "stem"))   # an empty list stays an empty list
    g = j.groupBy("cid").agg(F.sort_array(F.collect_list(one)).alias("s"))
    return g.select("cid", F.transform("s", lambda x: x["stem"]).alias("tokens"))


# ---------------------------------------------------------------- n-grams
def _grams(tok, n: int):
    """n-grams joined by '_', built by zipping shifted slices (one pass per
    n, no per-position slicing)."""
    size = F.size(tok)
    g = tok
    for k in range(2, n + 1):
        m = F.greatest(size - (k - 1), F.lit(0))
        g = F.zip_with(F.slice(g, 1, m), F.slice(tok, k, m),
                       lambda a, b: F.concat(a, F.lit("_"), b))
    return g


def ngram_sentence(tok, n: int):
    """Each word followed by the n-gram that starts at it (where one fits)."""
    z = F.arrays_zip(tok.alias("w"), _grams(tok, n).alias("g"))
    inter = F.flatten(F.transform(z, lambda s: F.array(s["w"], s["g"])))
    return F.filter(inter, lambda x: x.isNotNull())


def ngram_sentences(sents: DataFrame) -> DataFrame:
    s = sents.filter(F.size("tokens") > 1)
    return s.select("cid", *[ngram_sentence(F.col("tokens"), n).alias(f"gram{n}") for n in (2, 3, 4)])


def word_frequency(sents: DataFrame) -> DataFrame:
    """Word counts; partial aggregation collapses hot words map-side."""
    return sents.select(F.explode("tokens").alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def comment_word_frequency(comments: DataFrame, symbols: DataFrame) -> DataFrame:
    """Word counts of the cleaned comments from the token rows themselves: no
    document is put together again only to be taken apart."""
    rows = _token_rows(clean_text(comments), symbols).filter("keep_stop")
    return rows.groupBy(F.col("low").alias("word")).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- phrases
def _pair_rows(sents: DataFrame) -> DataFrame:
    """(cid, pos, a, b): every token with its successor (null at the end),
    from the array itself (zip with the shifted slice), no sort needed."""
    t = F.col("tokens")
    z = F.arrays_zip(t.alias("a"), F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))).alias("b"))
    return sents.select("cid", F.posexplode(z).alias("pos", "p")).select("cid", "pos", "p.a", "p.b")


def phrase_table(sents: DataFrame, min_count: int = 3, threshold: float = 10.0) -> DataFrame:
    """Collocations scored as (n(ab) - min_count) * V / (n(a) n(b)), V the
    number of distinct words plus distinct pairs; pairs above threshold.
    Word and pair counts are map-side combined aggregates, written once
    because they are read for V and for the score; a pair that is not above the
    least count scores zero at most and does not meet the word counts."""
    ex = _pair_rows(sents)
    na = written(ex.groupBy("a").agg(F.count("*").alias("n_a")))
    nab = written(ex.filter(F.col("b").isNotNull()).groupBy("a", "b").agg(F.count("*").alias("n_ab")))
    vocab = float(na.count() + nab.count())    # two scalars to the driver
    nb = na.select(F.col("a").alias("b"), F.col("n_a").alias("n_b"))
    if threshold >= 0:
        nab = nab.filter(F.col("n_ab") > min_count)
    sc = (nab.join(na, "a").join(nb, "b")
          .withColumn("score", (F.col("n_ab") - min_count) / F.col("n_a") / F.col("n_b") * F.lit(vocab)))
    # read by the merge, which may look at its size before it joins
    return written(sc.filter(F.col("score") > threshold).select("a", "b", "n_ab", "n_a", "n_b", "score"))


def apply_phrases(sents: DataFrame, phrases: DataFrame) -> DataFrame:
    """Greedy left-to-right merge of phrase pairs into 'a_b' tokens.

    A position starts a phrase when (w_i, w_i+1) is in the table.  Inside a
    run of consecutive starting positions the greedy scan takes every second
    one; the word after a taken start is consumed.  Runs come from the
    gaps-and-islands trick (position minus row number) on the starting
    positions alone.  They come back to their document as one short list; its
    marks (joined word, consumed word) sort in front of the words they replace."""
    w = Window.partitionBy("cid").orderBy("pos")
    st = _pair_rows(sents).join(phrases.select("a", "b"), ["a", "b"], "left_semi").select("cid", "pos")
    st = st.withColumn("grp", F.col("pos") - F.row_number().over(w))
    st = st.withColumn("start", F.min("pos").over(Window.partitionBy("cid", "grp")))
    taken = st.filter(((F.col("pos") - F.col("start")) % 2) == 0).groupBy("cid").agg(F.collect_list("pos").alias("taken"))
    docs = sents.filter(F.col("tokens").isNotNull()).select("cid", "tokens").join(taken, "cid", "left")

    def mark(pos, kind, tok):
        return F.struct(pos.alias("pos"), F.lit(kind).alias("kind"), tok.alias("tok"))
    joined, consumed, word = 0, 1, 2
    marks = F.flatten(F.transform("taken", lambda p: F.array(
        mark(p, joined, F.concat_ws("_", F.get("tokens", p), F.get("tokens", p + 1))), mark(p + 1, consumed, F.lit(None).cast("string")))))
    line = F.sort_array(F.concat(marks, F.transform("tokens", lambda t, i: mark(i, word, t))))
    docs = docs.select("cid", "tokens", F.when(F.col("taken").isNotNull(), line).alias("line"))
    at = F.arrays_zip(F.col("line").alias("e"), F.concat(F.array(F.lit(-1)), F.transform("line", lambda e: e["pos"])).alias("before"))
    kept = F.filter(at, lambda x: (x["e"]["kind"] == joined) | ((x["e"]["kind"] == word) & (x["e"]["pos"] != x["before"])))
    return docs.select("cid", F.when(F.col("line").isNull(), F.col("tokens")).otherwise(F.transform(kept, lambda x: x["e"]["tok"])).alias("tokens"))


def phrases(sents: DataFrame, min_count: int = 3, threshold: float = 10.0) -> DataFrame:
    """Score pairs, then merge them; the sentences are read four times, so
    they are written once instead of recomputing the cleaning chain."""
    sents = written(sents)
    return apply_phrases(sents, phrase_table(sents, min_count, threshold))


# ---------------------------------------------------------------- vectors
def top_words(freq: DataFrame, n: int) -> list[str]:
    """The n most frequent words (a top-k report: n rows to the driver)."""
    return [r[0] for r in freq.orderBy(F.desc("n"), "word").limit(n).collect()]


def _nearest(vectors: DataFrame, queries: list[tuple], label: str, kind: str, n: int) -> DataFrame:
    """The ``n`` words nearest by cosine to each query vector.  The queries are
    the rows of a report (some words, the cluster centres) and ride along as a
    literal; every word meets them where it is, and a window that Spark cuts
    to ``n`` rows per task and query ranks the scores."""
    def unit(v):
        length = sum(x * x for x in v) ** 0.5 or 1.0
        return [float(x / length) for x in v]
    q = F.array(*(F.struct(F.lit(name).cast(kind).alias("q"), F.array(*map(F.lit, unit(v))).alias("qv")) for name, v in queries))
    w = vectors.select(F.col("word").alias("w"), F.col("vector").cast("array<double>").alias("v"))
    dot = F.aggregate(F.zip_with("v", "x.qv", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, b: a + b * b))
    s = w.withColumn("x", F.explode(q)).select(F.col("x.q").alias(label), "w", (dot / F.nullif(size, F.lit(0.0))).alias("similarity"))
    rank = F.row_number().over(Window.partitionBy(label).orderBy(F.desc("similarity"), "w"))
    return s.filter(F.col("w") != F.col(label).cast("string")).withColumn("_r", rank).filter(F.col("_r") <= n).drop("_r")


def similar_words(vectors: DataFrame, words: list[str], n: int = 20) -> DataFrame:
    """The ``n`` words nearest to each of ``words``; ``vectors``: word, vector."""
    known = vectors.filter(F.col("word").isin(words)).collect()   # one row per asked word
    return _nearest(vectors, [(r.word, r.vector) for r in known], "word", "string", n) \
        .select("word", F.col("w").alias("similar"), "similarity")


def word_clusters(vectors: DataFrame, k: int = 10, n: int = 20, seed: int = 1, max_iter: int = 10_000, starts: int = 100) -> DataFrame:
    """k-means over the word vectors, the best of ``starts``; nearest words of
    each centroid."""
    centres, _ = best_kmeans(vectors, k, seed, max_iter, starts)
    return _nearest(vectors, list(enumerate(centres.tolist())), "cluster", "int", n) \
        .select("cluster", F.col("w").alias("word"), "similarity")


# ---------------------------------------------------------------- sinks
def write_partitioned(df: DataFrame, col: str, name: str) -> str:
    """Partitioned parquet sink under the shared checkpoint folder.  Rows are
    brought together by the partition column and a salt, so a folder gets a
    few files and a folder with very many rows is written by several tasks."""
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), name, uuid.uuid4().hex)
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(4))
    df.repartition(F.col(col), salt).write.mode("overwrite").partitionBy(col).parquet(path)
    return path
