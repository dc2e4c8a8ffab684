"""Aggregates that need more than one built-in call."""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def to_long(df: DataFrame, cols: Sequence[str], name: str = "item", value: str = "v") -> DataFrame:
    """Wide numeric columns to (name, value) rows, nulls dropped."""
    return df.unpivot([], list(cols), name, value).filter(F.col(value).isNotNull()) \
        .select(name, F.col(value).cast("double").alias(value))


def exact_quantiles(long: DataFrame, qs: Sequence[float], key: str = "item",
                    value: str = "v") -> DataFrame:
    """Exact linear-interpolated quantiles per key, without holding a group
    in one task and without moving rows through Python.

    Equal values are one row with a count, made before the shuffle, so a value
    that fills a third of the table is one row.  The distinct (key, value) rows
    are range-partitioned and sorted across the cluster; a row's first rank is
    the count of the partitions before its own, one sum per partition, plus
    the running count inside its partition.  Only the two order statistics
    around each (key, q) are fetched, so driver traffic is keys x quantiles
    rows plus one sum per partition, whatever the data size."""
    from ..session import cut_lineage
    spark = long.sparkSession
    distinct = long.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    ordered = cut_lineage(distinct.orderBy(key, value).withColumn("_p", F.spark_partition_id()))
    held = ordered.groupBy(key, "_p").agg(F.sum("_n")).collect()  # one row per key and partition it is in
    counts: dict = {}
    for k, _, n in held:
        counts[k] = counts.get(k, 0) + n
    if not counts:
        return spark.createDataFrame([], f"{key} string, q double, value double")
    offsets, run = {}, 0
    for k in sorted(counts):
        offsets[k] = run
        run += counts[k]
    plan, wanted = [], set()
    for k in sorted(counts):
        n = counts[k]
        for q in qs:
            pos = q * (n - 1)
            lo, hi = math.floor(pos), math.ceil(pos)
            plan.append((k, q, offsets[k] + lo, offsets[k] + hi, pos - lo))
            wanted.update((offsets[k] + lo, offsets[k] + hi))
    base, run = {}, 0
    for p in sorted({p for _, p, _ in held}):
        base[p] = run
        run += sum(n for _, at, n in held if at == p)
    base_map = F.create_map(*[F.lit(x) for p in base for x in (p, base[p])])
    before = Window.partitionBy("_p").orderBy(key, value).rowsBetween(Window.unboundedPreceding, -1)
    first = F.element_at(base_map, F.col("_p")) + F.coalesce(F.sum("_n").over(before), F.lit(0))
    asked = F.array(*(F.lit(w).cast("long") for w in sorted(wanted)))
    hit = F.filter(asked, lambda w: (w >= F.col("_first")) & (w < F.col("_first") + F.col("_n")))
    picked = {r[0]: r[1] for r in ordered.withColumn("_first", first).select(F.explode(hit).alias("i"), value).collect()}
    rows = []
    for k, q, lo, hi, frac in plan:
        a, b = picked[lo], picked[hi]
        rows.append((k, float(q), a + (b - a) * frac))
    return spark.createDataFrame(rows, f"{key} string, q double, value double")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, one row per column."""
    long = to_long(df, cols)
    stats = long.groupBy("item").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    qv = exact_quantiles(long, [0.25, 0.5, 0.75])
    wide = qv.groupBy("item").pivot("q", [0.25, 0.5, 0.75]).agg(F.first("value"))
    wide = wide.toDF("item", "p25", "p50", "p75")
    return stats.join(wide, "item").select("item", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def rolling_deviation(df: DataFrame, value: str, key: str, order: str, n: int, name: str) -> DataFrame:
    """``name``: sample deviation of ``value`` over the last ``n`` rows of the
    key, null unless all of them have a value.

    Rows are cut into blocks of ``n``.  A frame of ``n`` rows is the end of one
    block and the beginning of the next, so two running (count, mean, sum of
    squares about the mean), one from each end of the block, and one merge give
    every frame: a constant number of steps a row, and no difference of large
    sums to lose digits in."""
    line = Window.partitionBy(key).orderBy(order)
    d = df.withColumn("_i", F.row_number().over(line) - 1).withColumn("_b", F.floor(F.col("_i") / n))
    block, placed = Window.partitionBy(key, "_b"), Window.partitionBy(key).orderBy("_b", "_i")  # the sort of the block's windows serves both

    def moments(w):
        w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        c = F.count(value).over(w)
        return F.struct(c.alias("n"), F.avg(value).over(w).alias("mean"), (F.var_pop(value).over(w) * c).alias("m2"))
    d = d.withColumn("_tail", moments(block.orderBy(F.desc("_i")))).withColumn("_head", moments(block.orderBy("_i")))
    d = d.withColumn("_rest", F.when((F.col("_i") + 1) % n != 0, F.lag("_tail", n - 1).over(placed)))
    c = F.col("_head.n") + F.coalesce("_rest.n", F.lit(0))
    apart = F.col("_head.mean") - F.col("_rest.mean")
    m2 = F.when(F.coalesce("_rest.n", F.lit(0)) == 0, F.col("_head.m2")).when(F.col("_head.n") == 0, F.col("_rest.m2")) \
        .otherwise(F.col("_head.m2") + F.col("_rest.m2") + apart * apart * F.col("_head.n") * F.col("_rest.n") / c)
    return d.withColumn(name, F.when(c >= n, F.sqrt(m2 / (n - 1)))).drop("_i", "_b", "_head", "_tail", "_rest")
