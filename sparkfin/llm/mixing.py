"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree.

Every source is cut into blocks of documents; a block is the unit that is
dealt.  A source's exact quota is a number of words: whole passes over all its
blocks and a remainder drawn from its permuted blocks.  A binary tree splits
the quotas (in blocks, per source) among the output shards: a node hands half
of its blocks to its left child, drawn without replacement, so the counts per
source follow the multivariate hypergeometric law.  Shards then take disjoint
runs of each source's permuted blocks and shuffle their rows locally.

Everything is DataFrame and SQL expressions.  Rows meet only by (source,
block): a source that holds a third of all rows is many blocks.  What is kept
per source (targets, quotas, tree) is one row per source and shard.

Defined results: a null text has size 0 and takes nothing; a null source is a
source of its own, last in order; a null or repeated id is a row like any
other; an empty table gives an empty mix; other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import word_count, written

WEIGHTS = (1, 2, 3)
CAP = 3
BLOCK_ROWS = 1000
LEVELS = 3
SEED = "mix-1"
#: blocks whose running sums one task makes
RUN_BLOCKS = 4096
#: prime above any number of blocks of a source, so that multiplying permutes them
PRIME = 1_000_000_007


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """(id, source, size, key): size in words, key a fixed random order."""
    return docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary")).alias("key"))


def targets(rows: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source: its place in code-point order (null last), size and
    target.  Sources share all words by weight; none may pass ``cap`` times its
    size.  Sorted by size per weight the sources that stop there come first, so
    running sums give the level at which the rest share what is left."""
    s = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("source"))
    s = s.withColumn("place", F.row_number().over(by_name) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
    s = s.withColumn("most", F.col("source_size") * cap)
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("most") / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    here_on = order.rowsBetween(0, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0)))
                     / F.sum("weight").over(here_on))
    s = s.withColumn("full", F.col("most") / F.col("weight") < F.col("level"))
    s = s.withColumn("common", F.max(F.when(~F.col("full"), F.col("level"))).over(everything))
    return s.select("place", "source", "source_size", "rows", F.when(F.col("full"), F.col("most").cast("double"))
                    .otherwise(F.col("weight") * F.col("common")).alias("target"))


def blocks(rows: DataFrame, plan: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows with their source's plan, block and running words inside the block."""
    p = plan.withColumn("blocks", F.ceil(F.col("rows") / block_rows)) \
            .withColumn("quota", F.floor("target")) \
            .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("quota") / F.col("source_size"))).otherwise(0)) \
            .withColumn("rest", F.col("quota") - F.col("passes") * F.col("source_size")) \
            .withColumnRenamed("source", "name").drop("rows", "quota")
    r = rows.join(p, rows.source.eqNullSafe(p.name)).drop("name")
    r = r.withColumn("block", F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % F.col("blocks"))
    inside = Window.partitionBy("place", "block").orderBy("key", F.asc_nulls_last("id"), "size")
    return r.withColumn("nth", F.row_number().over(inside)) \
            .withColumn("before", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def draws(rows: DataFrame) -> DataFrame:
    """The blocks the mix takes: (place, block, round, words, turn, drawn).
    Rounds below ``passes`` are whole; the last takes the remainder, block by
    block in permuted order, the last one in part.  ``turn`` numbers a source's
    ``drawn`` blocks in a second permutation, from 0.  Running sums go over runs
    of blocks first and inside each run then, so no task holds a whole source."""
    b = written(rows.groupBy("place", "block").agg(F.sum("size").alias("words"), *(F.first(c).alias(c) for c in ("passes", "rest")))
                .filter("words > 0").withColumn("run", F.floor(F.col("block") / RUN_BLOCKS)), "mix-blocks")
    ahead = Window.partitionBy("place").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = b.groupBy("place", "run").agg(F.sum("words").alias("w"), F.count(F.lit(1)).alias("k"))
    runs = runs.select("place", "run", F.coalesce(F.sum("w").over(ahead), F.lit(0)).alias("words_ahead"),
                       F.coalesce(F.sum("k").over(ahead), F.lit(0)).alias("blocks_ahead"),
                       F.sum("k").over(Window.partitionBy("place")).alias("all_blocks"))
    inside = Window.partitionBy("place", "run").orderBy("block")
    b = b.withColumn("left", F.col("rest") - F.coalesce(F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("nth", F.row_number().over(inside) - 1).join(runs, ["place", "run"])
    b = b.withColumn("left", F.col("left") - F.col("words_ahead")).withColumn("nth", F.col("nth") + F.col("blocks_ahead"))
    b = b.withColumn("round", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))))
    b = b.withColumn("words", F.when(F.col("round") < F.col("passes"), F.col("words")).otherwise(F.least("words", "left"))).filter("words > 0")
    b = written(b.select("place", "block", "round", "words", (F.col("round") * F.col("all_blocks") + F.col("nth")).alias("at")), "mix-draws")
    n = b.groupBy("place").agg(F.count(F.lit(1)).alias("drawn"))
    return b.join(n, "place").withColumn("turn", F.col("at") * F.lit(PRIME) % F.col("drawn")).select("place", "block", "round", "words", "turn", "drawn")


def split(node: DataFrame, level: int) -> DataFrame:
    """One level of the tree: (node, place, item) rows move to node * 2 or
    node * 2 + 1.  The left child gets the half of a node's items with the
    smallest keys, a draw without replacement, so its counts per source are
    multivariate hypergeometric.  Items are counted by the first four digits of
    their key; only those of one digit group of a node are ranked in one task."""
    key = F.md5(F.concat_ws(":", F.lit(SEED), F.lit(str(level)), *(F.col(c).cast("string") for c in ("node", "place", "item"))).cast("binary"))
    keyed = node.withColumn("key", key).withColumn("group", F.substring("key", 1, 4))
    groups = keyed.groupBy("node", "group").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("node").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("node", "group", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"),
                           F.sum("n").over(Window.partitionBy("node")).alias("total"))
    rank = F.row_number().over(Window.partitionBy("node", "group").orderBy("key", "place", "item"))
    halves = keyed.withColumn("rank", rank).join(groups, ["node", "group"])
    right = F.when(F.col("ahead") + F.col("rank") <= F.floor(F.col("total") / 2), 0).otherwise(1)
    return written(halves.select((F.col("node") * 2 + right).alias("node"), "place", "item"), f"mix-level-{level}")


def shard_quotas(drawn: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(place, ends): for each source the running block quota of the 2**levels
    shards, from the leaves of the splitting tree over all drawn blocks."""
    root = drawn.select("place", "drawn").distinct()
    node = root.select(F.lit(0).cast("long").alias("node"), "place", F.explode(F.sequence(F.lit(1).cast("long"), F.col("drawn"))).alias("item"))
    for level in range(levels):
        node = split(node, level)
    return node.groupBy("place").agg(F.array(*(F.count(F.when(F.col("node") <= j, 1)) for j in range(2 ** levels))).alias("ends"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, cap: int = CAP, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """Returns (rows, dealt).  ``rows``: one row per input row with its source's
    size and target.  ``dealt``: one row per row and round the mix takes it,
    with shard, words (whole, or the first words where the remainder ends) and
    ``spot``, a random key that orders the rows of a shard."""
    facts = written(sized(docs, id_col, text_col, source_col), "mix-sizes")
    rows = blocks(facts, targets(facts, weights, cap))
    drawn = draws(rows)
    shard = F.size(F.filter("ends", lambda e: e <= F.col("turn")))
    drawn = drawn.join(shard_quotas(drawn, levels), "place").withColumn("shard", shard).withColumnRenamed("words", "quota").drop("ends", "turn", "drawn")
    dealt = rows.join(drawn, ["place", "block"]).withColumn("words", F.least("size", F.col("quota") - F.col("before"))) \
        .filter("words > 0").select("place", "block", "nth", "id", "source", "round", "shard", "words",
                                    F.xxhash64(F.lit(SEED), "shard", "key", "nth", "round").alias("spot"))
    return rows, dealt


def taken(rows: DataFrame, dealt: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Per input row: id, source, size, source_size, target, the words taken,
    and shard_words, the words each shard took (in order, joined by commas)."""
    key = ["place", "block", "nth"]
    shards = [F.sum(F.when(F.col("shard") == j, F.col("words")).otherwise(0)).alias(f"shard_{j}") for j in range(2 ** levels)]
    got = dealt.groupBy(*key).agg(F.sum("words").alias("taken"), *shards)
    listed = F.concat_ws(",", *(F.coalesce(F.col(f"shard_{j}"), F.lit(0).cast("long")).cast("string") for j in range(2 ** levels)))
    return rows.join(got, key, "left").select("id", "source", "size", "source_size", "target",
                                              F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), listed.alias("shard_words"))


def write_shards(dealt: DataFrame, path: str) -> None:
    """Write the mix, one folder per shard, rows in shuffled order.  A shard is
    cut by ranges of its random key, so no task holds a whole shard."""
    dealt.repartitionByRange("shard", "spot").sortWithinPartitions("shard", "spot") \
        .select("shard", "id", "source", "round", "words").write.partitionBy("shard").parquet(path)


ORACLE = r"""
with rows as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5('mix-1:' || coalesce(doc_id::varchar, '')) as key from documents),
s as (select source, sum(size)::bigint as source_size, count(*) as n from rows group by source),
w as (select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 1 when 1 then 2 else 3 end as weight,
             row_number() over (order by source nulls last) as place, 3 * source_size as most from s),
l as (select *, (sum(source_size) over () - coalesce(sum(most) over (order by most / weight, place rows between unbounded preceding and 1 preceding), 0))::double
             / sum(weight) over (order by most / weight, place rows between current row and unbounded following) as level from w),
t as (select source, source_size, n, place, case when most / weight < level then most::double
             else weight * (select max(level) from l where not most / weight < level) end as target from l),
p as (select rows.*, place, source_size, target, floor(target)::bigint as quota,
             ('0x' || substr(key, 1, 8))::bigint % ceil(n / 1000)::bigint as block
      from rows join t on rows.source is not distinct from t.source),
c as (select *, coalesce(sum(size) over (partition by place, block order by key, doc_id, size rows between unbounded preceding and 1 preceding), 0) as before,
             case when source_size > 0 then quota // source_size else 0 end as passes, row_number() over () as line from p),
b as (select place, block, sum(size)::bigint as words, any_value(passes) as passes, any_value(quota - passes * source_size) as rest from c group by place, block having sum(size) > 0),
l1 as (select *, rest - coalesce(sum(words) over (partition by place order by block rows between unbounded preceding and 1 preceding), 0) as room from b),
d as (select place, block, round, case when round < passes then words else least(words, room) end as words
      from (select *, unnest(range(0, passes + 1)) as round from l1)),
e as (select *, row_number() over (partition by place order by round, block) - 1 as at, count(*) over (partition by place) as drawn from d where words > 0),
n0 as (select 0 as node, place, unnest(range(1, drawn + 1)) as item from (select distinct place, drawn from e)),
n1 as (select node * 2 + case when row_number() over (partition by node order by md5('mix-1:0:' || node || ':' || (place - 1) || ':' || item), place, item)
       <= count(*) over (partition by node) // 2 then 0 else 1 end as node, place, item from n0),
n2 as (select node * 2 + case when row_number() over (partition by node order by md5('mix-1:1:' || node || ':' || (place - 1) || ':' || item), place, item)
       <= count(*) over (partition by node) // 2 then 0 else 1 end as node, place, item from n1),
n3 as (select node * 2 + case when row_number() over (partition by node order by md5('mix-1:2:' || node || ':' || (place - 1) || ':' || item), place, item)
       <= count(*) over (partition by node) // 2 then 0 else 1 end as node, place, item from n2),
q as (select place, list(ended order by node) as ends from (
      select place, j.node, (select count(*) from n3 where n3.place = s.place and n3.node <= j.node) as ended
      from (select distinct place from n3) s, (select unnest(range(0, 8)) as node) j) group by place),
g as (select c.line, len(list_filter(q.ends, lambda x: x <= (e.at * 1000000007) % e.drawn)) as shard, least(c.size, e.words - c.before) as words
      from c join e on c.place = e.place and c.block = e.block join q on q.place = c.place where least(c.size, e.words - c.before) > 0),
h as (select line, sum(words)::bigint as taken, coalesce(sum(words) filter (shard = 0), 0)::bigint
       || ',' || coalesce(sum(words) filter (shard = 1), 0)::bigint
       || ',' || coalesce(sum(words) filter (shard = 2), 0)::bigint
       || ',' || coalesce(sum(words) filter (shard = 3), 0)::bigint
       || ',' || coalesce(sum(words) filter (shard = 4), 0)::bigint
       || ',' || coalesce(sum(words) filter (shard = 5), 0)::bigint
       || ',' || coalesce(sum(words) filter (shard = 6), 0)::bigint
       || ',' || coalesce(sum(words) filter (shard = 7), 0)::bigint as shard_words from g group by line)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken, coalesce(shard_words, '0,0,0,0,0,0,0,0') as shard_words
from c left join h on c.line = h.line
"""
