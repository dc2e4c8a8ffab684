"""Forum-text queries."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.fixed import CONTRACTIONS, STOPWORDS_EN
from ..functions.porter import STEP2, STEP3, STEP4
from ..operators import text as T
from ..operators import word_vectors as V
from ..sources import adapters as A
from . import oracle as O
from .registry import register


def L(spark, sf, name):
    return A.load(spark, sf, name)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_CASE_CONTR = "CASE lower(t) " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in CONTRACTIONS.items()) + " ELSE t END"
_STOP = "[" + ", ".join(_q(w) for w in STOPWORDS_EN) + "]"
_WS = r"'[ \t\n\f\r]+'"

_TEXT_CTES = f"""dd AS (
  SELECT *, cast(comment_index_track AS string) || ':' || cast(position AS string) AS cid FROM (
    SELECT *, row_number() OVER (PARTITION BY comment ORDER BY sub_date DESC, sub, comment_index_track, position) AS rn
    FROM a_comments) t WHERE rn = 1),
clean AS (
  SELECT cid, regexp_replace(array_to_string(list_transform(regexp_split_to_array(comment, {_WS}),
           lambda t: {_CASE_CONTR}), ' '), '[^\\p{{L}}\\p{{N}}_ \\t\\n\\f\\r]', ' ', 'g') AS clean FROM dd),
ctok AS (
  SELECT cid, unnest(toks) AS tok, unnest(generate_series(1, len(toks))) AS pos
  FROM (SELECT cid, regexp_split_to_array(clean, {_WS}) AS toks FROM clean) t),
replaced AS (
  SELECT c.cid, coalesce(list(coalesce(s.name_lower, c.tok) ORDER BY c.pos) FILTER (WHERE c.tok <> ''), []) AS tokens
  FROM ctok c LEFT JOIN a_symbols s ON c.tok = s.symbol GROUP BY c.cid),
toks AS (
  SELECT cid, list_filter(list_transform(tokens, lambda t: lower(t)), lambda t: regexp_full_match(t, '\\p{{L}}+'))
         AS tokens FROM replaced),
sents AS (SELECT cid, list_filter(tokens, lambda t: NOT list_contains({_STOP}, t)) AS tokens FROM toks),
ex AS (SELECT cid, unnest(tokens) AS a, unnest(generate_series(1, len(tokens))) AS pos FROM sents)"""


def _tsql(body: str, extra: str = "") -> str:
    return O.sql(["a_comments", "a_symbols"], body, _TEXT_CTES + ("," + extra if extra else ""))


def _sents(spark, sf):
    return T.sentences(L(spark, sf, "a_comments"), L(spark, sf, "a_symbols"))


# ---------------------------------------------------------------- threads
register("daily_thread_ids", O.sql(["a_submissions"], """
SELECT day, id, title FROM (
  SELECT cast(date_trunc('day', created_utc) AS date) AS day, id, title,
         row_number() OVER (PARTITION BY cast(date_trunc('day', created_utc) AS date) ORDER BY created_utc, id) AS rn
  FROM a_submissions WHERE contains(title, 'Daily Discussion -') AND contains(author, 'AutoModerator')) t
WHERE rn = 1"""))(lambda spark, sf: T.daily_thread_ids(L(spark, sf, "a_submissions")))

@register("thread_ids_merged", O.sql(["a_submissions"], """
WITH s AS (SELECT cast(date_trunc('day', created_utc) AS date) AS day, created_utc, id FROM a_submissions
           WHERE contains(title, 'Daily Discussion -') AND contains(author, 'AutoModerator')),
m AS (SELECT min(day) + cast(date_diff('day', min(day), max(day)) // 2 AS int) AS cut FROM s),
a AS (SELECT day, arg_min(id, (created_utc, id)) AS id FROM s, m WHERE day <= cut GROUP BY day),
b AS (SELECT day, arg_max(id, (created_utc, id)) AS id FROM s, m WHERE day >= cut GROUP BY day)
SELECT day, coalesce(b.id, a.id) AS id FROM a FULL JOIN b USING (day)""".replace("WITH s AS", "SELECT * FROM (WITH s AS") + ") t"))
def thread_ids_merged(spark, sf):
    """Two captures of thread ids that overlap in one day, merged as one
    dictionary: the later capture's value stays."""
    s = T.moderator_threads(L(spark, sf, "a_submissions"))
    lo, hi = s.agg(F.min("day"), F.max("day")).first()
    cut = F.date_add(F.lit(lo), (hi - lo).days // 2) if lo else F.lit(None).cast("date")
    when = F.struct("created_utc", "id")
    first = s.filter(F.col("day") <= cut).groupBy("day").agg(F.min_by("id", when).alias("id"))
    second = s.filter(F.col("day") >= cut).groupBy("day").agg(F.max_by("id", when).alias("id"))
    return T.merge_last(first, second, "day", "id")


register("comments_flat", O.sql(["a_comments"], """
SELECT c.*, CASE WHEN c.position > 0 THEN p.author END AS parent_author
FROM a_comments c LEFT JOIN (SELECT comment_index_track, author FROM a_comments WHERE position = 0) p
  ON c.comment_index_track = p.comment_index_track
WHERE c.author IS NOT NULL AND c.author <> '[deleted]'"""))(
    lambda spark, sf: T.comments_flat(L(spark, sf, "a_comments")))

register("comments_authors", O.sql(["a_comments", "a_authors", "a_threads"], """
SELECT c.*, CASE WHEN c.position > 0 THEN (
         SELECT p.author FROM a_comments p WHERE p.position = 0 AND p.comment_index_track = c.comment_index_track) END AS parent_author,
       a.* EXCLUDE (author), t.* EXCLUDE (sub)
FROM a_comments c JOIN a_authors a ON a.author = c.author LEFT JOIN a_threads t ON t.sub = c.sub
WHERE c.author <> '[deleted]'"""))(
    lambda spark, sf: T.comment_authors(L(spark, sf, "a_comments"), L(spark, sf, "a_authors"), L(spark, sf, "a_threads")))

_COMMENT_COLS = ["sub", "sub_date", "comment_index_track", "position", "kind", "author", "comment", "comment_upvotes"]


@register("load_comment_partitions", O.sql(["a_comments"], f"SELECT {', '.join(_COMMENT_COLS)} FROM a_comments"))
def load_comment_partitions(spark, sf):
    """Daily partitions written by date, read back as one table, newest first."""
    path = T.write_partitioned(L(spark, sf, "a_comments").select(*_COMMENT_COLS), "sub_date", "comment_days")
    back = spark.read.parquet(path)
    return back.select(*_COMMENT_COLS).orderBy(F.desc("sub_date"), "sub", "comment_index_track", "position")


@register("comments_by_thread", O.sql(["a_comments"], """
SELECT sub, count(*) AS n_rows, count(*) FILTER (WHERE position > 0) AS n_replies, cast(sum(length(comment)) AS bigint) AS n_chars
FROM a_comments GROUP BY sub"""))
def comments_by_thread(spark, sf):
    """One output folder per thread holding its comments; counts read back
    from the sink."""
    path = T.write_partitioned(L(spark, sf, "a_comments").select(*_COMMENT_COLS), "sub", "comment_threads")
    back = spark.read.parquet(path)
    return back.groupBy("sub").agg(F.count("*").alias("n_rows"),
                                   F.count(F.when(F.col("position") > 0, 1)).alias("n_replies"),
                                   F.sum(F.length("comment")).alias("n_chars"))


# ---------------------------------------------------------------- cleaning
register("text_clean", _tsql("SELECT cid, clean FROM clean"))(
    lambda spark, sf: T.clean_text(L(spark, sf, "a_comments")))

register("text_symbol_replace", _tsql("SELECT cid, tokens FROM replaced"))(
    lambda spark, sf: T.symbol_replace(T.clean_text(L(spark, sf, "a_comments")), L(spark, sf, "a_symbols")))

register("text_tokens", _tsql("SELECT cid, tokens FROM toks"))(
    lambda spark, sf: T.tokens_from_clean(T.clean_text(L(spark, sf, "a_comments")), L(spark, sf, "a_symbols")))

register("text_stopwords", _tsql("SELECT cid, tokens FROM sents"))(_sents)


def _stem_sql() -> str:
    """The stemmer's rules in DuckDB: the shape is a fold over the characters,
    a suffix is looked up in a table, and the shape is made anew at each step."""
    def shape(w):
        return (f"list_reduce(list_prepend('', string_split({w}, '')), lambda a, c: a || CASE WHEN contains('aeiou', c) AND c <> '' THEN 'V' "
                f"WHEN c = 'y' AND ends_with(a, 'C') THEN 'V' WHEN c = '' THEN '' ELSE 'C' END)")

    def less(k):
        return f"left(p, length(p) - {k})"

    def m0(x):
        return f"regexp_matches({x}, '^C*V+C')"

    def m1(x):
        return f"regexp_matches({x}, '^C*V+C+V+C')"

    def once(x):
        return f"regexp_matches({x}, '^C*V+C+V*$')"

    def ends(*suffixes):
        return "(" + " OR ".join(f"ends_with(w, '{x}')" for x in suffixes) + ")"

    def suffix_table(rules):
        return ("(SELECT arg_max(struct_pack(suf := suf, rep := rep), length(suf)) FROM (VALUES "
                + ", ".join(f"('{a}', '{b}')" for a, b in rules.items()) + ") t(suf, rep) WHERE ends_with(w, suf))")
    names: list[str] = []
    ctes = ["st0 AS (SELECT DISTINCT a AS word, lower(a) AS w FROM ex)"]

    def step(expr, extra=""):
        n = len(names)
        names.append(f"st{n + 1}")
        ctes.append(f"st{n + 1} AS (SELECT word, {expr} AS w{extra} FROM (SELECT *, {shape('w')} AS p FROM st{n}) t)")

    def by_table(rules, cond):
        n = len(names)
        names.append(f"st{n + 1}")
        ctes.append(f"st{n + 1} AS (SELECT word, CASE WHEN r IS NOT NULL AND {cond} THEN left(w, length(w) - length(r.suf)) || r.rep "
                    f"ELSE w END AS w FROM (SELECT *, {shape('w')} AS p, {suffix_table(rules)} AS r FROM st{n}) t)")
    ed, ing = f"({ends('ed')} AND contains({less(2)}, 'V'))", f"({ends('ing')} AND contains({less(3)}, 'V'))"
    double = "(length(w) >= 2 AND right(w, 1) = left(right(w, 2), 1) AND ends_with(p, 'C'))"
    step(f"CASE WHEN {ends('sses', 'ies')} THEN left(w, length(w) - 2) WHEN {ends('ss')} THEN w WHEN {ends('s')} THEN left(w, length(w) - 1) ELSE w END")
    step(f"CASE WHEN {ends('eed')} THEN CASE WHEN {m0(less(3))} THEN left(w, length(w) - 1) ELSE w END "
         f"WHEN {ed} THEN left(w, length(w) - 2) WHEN {ing} THEN left(w, length(w) - 3) ELSE w END",
         f", NOT {ends('eed')} AND ({ed} OR {ing}) AS mend")
    step(f"CASE WHEN NOT mend THEN w WHEN {ends('at', 'bl', 'iz')} THEN w || 'e' "
         f"WHEN {double} AND right(w, 1) NOT IN ('l', 's', 'z') THEN left(w, length(w) - 1) "
         f"WHEN {once('p')} AND ends_with(p, 'CVC') AND right(w, 1) NOT IN ('w', 'x', 'y') THEN w || 'e' ELSE w END")
    step(f"CASE WHEN {ends('y')} AND contains({less(1)}, 'V') THEN left(w, length(w) - 1) || 'i' ELSE w END")
    by_table(STEP2, m0(less("length(r.suf)")))
    by_table(STEP3, m0(less("length(r.suf)")))
    by_table({x: "" for x in STEP4}, m1(less("length(r.suf)")) + f" AND (r.suf <> 'ion' OR {ends('sion', 'tion')})")
    step(f"CASE WHEN {ends('e')} AND ({m1(less(1))} OR ({once(less(1))} AND NOT (ends_with({less(1)}, 'CVC') "
         f"AND left(right(w, 2), 1) NOT IN ('w', 'x', 'y')))) THEN left(w, length(w) - 1) ELSE w END")
    step(f"CASE WHEN {double} AND {ends('l')} AND {m1('p')} THEN left(w, length(w) - 1) ELSE w END")
    ctes.append(f"stems AS (SELECT word, CASE WHEN length(word) <= 2 THEN lower(word) ELSE w END AS stem FROM {names[-1]})")
    return _tsql("""
SELECT s.cid, coalesce(g.tokens, []) AS tokens
FROM sents s LEFT JOIN (SELECT cid, list(stem ORDER BY pos) AS tokens FROM ex JOIN stems ON ex.a = stems.word GROUP BY cid) g ON s.cid = g.cid""",
                 ",\n".join(ctes))


@register("text_stems", _stem_sql())
def text_stems(spark, sf):
    return T.stems(_sents(spark, sf))


def _ngram_sql(n: int) -> str:
    return (f"flatten(list_transform(range(1, len(tokens) + 1), lambda i: CASE WHEN i + {n - 1} <= len(tokens) "
            f"THEN [tokens[i], array_to_string(tokens[i:i + {n - 1}], '_')] ELSE [tokens[i]] END)) AS gram{n}")


register("ngram_sentences", _tsql(f"SELECT cid, {', '.join(_ngram_sql(n) for n in (2, 3, 4))} "
                                  "FROM sents WHERE len(tokens) > 1"))(
    lambda spark, sf: T.ngram_sentences(_sents(spark, sf)))

register("word_frequency", _tsql("SELECT a AS word, count(*) AS n FROM ex GROUP BY a"))(
    lambda spark, sf: T.comment_word_frequency(L(spark, sf, "a_comments"), L(spark, sf, "a_symbols")))


# ---------------------------------------------------------------- phrases
def _phrase_ctes(src: str, p: str) -> str:
    """DuckDB: phrase table from sentence CTE ``src`` and its greedy merge."""
    return f"""{p}_ex AS (SELECT cid, unnest(tokens) AS a, unnest(generate_series(1, len(tokens))) AS pos FROM {src}),
{p}_pairs AS (SELECT cid, pos, a, lead(a) OVER (PARTITION BY cid ORDER BY pos) AS b FROM {p}_ex),
{p}_na AS (SELECT a, count(*) AS n_a FROM {p}_ex GROUP BY a),
{p}_nab AS (SELECT a, b, count(*) AS n_ab FROM {p}_pairs WHERE b IS NOT NULL GROUP BY a, b),
{p}_tab AS (
  SELECT x.a, x.b FROM {p}_nab x JOIN {p}_na ua ON x.a = ua.a JOIN {p}_na ub ON x.b = ub.a
  WHERE (x.n_ab - 3) / ua.n_a / ub.n_a * ((SELECT count(*) FROM {p}_na) + (SELECT count(*) FROM {p}_nab)) > 10.0),
{p}_flag AS (
  SELECT q.*, (t.a IS NOT NULL) AS is_p FROM {p}_pairs q LEFT JOIN {p}_tab t ON q.a = t.a AND q.b = t.b),
{p}_st AS (
  SELECT cid, pos, pos - row_number() OVER (PARTITION BY cid ORDER BY pos) AS grp FROM {p}_flag WHERE is_p),
{p}_take AS (
  SELECT cid, pos FROM (SELECT *, min(pos) OVER (PARTITION BY cid, grp) AS start FROM {p}_st) t
  WHERE (pos - start) % 2 = 0),
{p}_t AS (
  SELECT f.*, (k.pos IS NOT NULL) AS take FROM {p}_flag f LEFT JOIN {p}_take k ON f.cid = k.cid AND f.pos = k.pos),
{p}_out AS (
  SELECT cid, list(CASE WHEN take THEN a || '_' || b ELSE a END ORDER BY pos) AS tokens FROM (
    SELECT *, coalesce(lag(take) OVER (PARTITION BY cid ORDER BY pos), false) AS consumed FROM {p}_t) t
  WHERE NOT consumed GROUP BY cid
  UNION ALL SELECT cid, tokens FROM {src} WHERE len(tokens) = 0)"""


register("phrases_bigram", _tsql("SELECT cid, tokens FROM p1_out", _phrase_ctes("sents", "p1")))(
    lambda spark, sf: T.phrases(_sents(spark, sf)))

register("phrases_trigram", _tsql("SELECT cid, tokens FROM p2_out",
                                  _phrase_ctes("sents", "p1") + ",\n" + _phrase_ctes("p1_out", "p2")))(
    lambda spark, sf: T.phrases(T.phrases(_sents(spark, sf))))


# ---------------------------------------------------------------- vectors
def _w2v(spark, sf):
    """Vectors of the bigram sentences (each word followed by the pair it
    opens), trained once per corpus, then loaded."""
    return V.saved_or_trained(T.ngram_sentences(_sents(spark, sf)).select("cid", F.col("gram2").alias("tokens")))


@register("word2vec_vectors")
def word2vec_vectors(spark, sf):
    return _w2v(spark, sf).select("word", F.col("vector").cast("array<double>").alias("vector"))


@register("word2vec_similar")
def word2vec_similar(spark, sf):
    """Neighbours of the ten most frequent words, from the saved vectors."""
    return T.similar_words(_w2v(spark, sf), T.top_words(T.word_frequency(_sents(spark, sf)), 10))


@register("word_clusters")
def word_clusters(spark, sf):
    return T.word_clusters(_w2v(spark, sf), k=10)


# ---------------------------------------------------------------- embeddings
_TOPK = 10


@register("topk_similar", f"""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
n AS (SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nv FROM e),
q AS (SELECT label, min(vec_id) AS qid FROM embeddings GROUP BY label),
qv AS (SELECT q.qid, n.v AS qv, n.nv AS qn FROM q JOIN n ON q.qid = n.vec_id),
s AS (
  SELECT qv.qid, n.vec_id,
         list_sum(list_transform(list_zip(qv.qv, n.v), lambda p: p[1] * p[2])) / (qv.qn * n.nv) AS sim
  FROM qv JOIN n ON n.vec_id <> qv.qid)
SELECT qid, vec_id, sim, rnk FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, vec_id) AS rnk FROM s) t
WHERE rnk <= {_TOPK}""")
def topk_similar(spark, sf, k: int = _TOPK):
    """Top-k cosine neighbours of one query vector per label.

    The query vectors (one per label) are inlined as a literal array, a
    thousand at a time, so every vector row scores itself against each query
    in place - no join and no shuffle for the scoring - and the per-query
    top-k is a ``row_number() <= k`` filter that Spark evaluates per
    partition before the final exchange."""
    e = L(spark, sf, "embeddings").select("vec_id", "label",
                                          F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    e = e.withColumn("nv", F.sqrt(F.aggregate(F.transform("v", lambda x: x * x), F.lit(0.0),
                                              lambda acc, x: acc + x)))
    qids = e.groupBy("label").agg(F.min("vec_id").alias("qid"))
    blocks = max(1, -(-2 * qids.count() // 1_000)) if qids.count() > 1_000 else 1
    found = None
    for b in range(blocks):
        mine = qids.filter(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == b)
        qrows = mine.join(e, mine.qid == e.vec_id).select("qid", "v", "nv").collect()   # one block of queries
        if not qrows:
            continue
        qarr = F.array(*[F.struct(F.lit(r.qid).cast("bigint").alias("qid"), F.array(*[F.lit(float(x)) for x in r.v]).alias("qv"),
                                  F.lit(r.nv).alias("qn")) for r in qrows])
        dot = F.aggregate(F.zip_with("q.qv", "v", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
        s = (e.select("vec_id", "v", "nv", F.explode(qarr).alias("q"))
             .filter(F.col("vec_id") != F.col("q.qid"))
             .select(F.col("q.qid").alias("qid"), "vec_id", (dot / (F.col("q.qn") * F.col("nv"))).alias("sim")))
        found = s if found is None else found.unionByName(s)
    if found is None:
        found = e.select(F.col("vec_id").alias("qid"), "vec_id", F.col("nv").alias("sim")).limit(0)
    w = Window.partitionBy("qid").orderBy(F.desc("sim"), "vec_id")
    return found.withColumn("rnk", F.row_number().over(w).cast("bigint")).filter(F.col("rnk") <= k)
