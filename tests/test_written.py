"""Tables written once and dealt by key into tasks of a bounded size."""
from pyspark.sql import functions as F

from sparkfin.session import by_key, written


def test_tasks_grow_with_the_table(spark):
    df = written(spark.range(10_000).select((F.col("id") % 997).alias("k"), F.lit(None).cast("date").alias("d")))
    assert [f.dataType.typeName() for f in df.schema.fields] == ["long", "date"] and df.count() == 10_000
    dealt = by_key(df, "k", rows=100)
    assert dealt.rdd.getNumPartitions() == 100 and dealt.select("k").distinct().count() == 997
    assert written(df.limit(0)).count() == 0 and by_key(written(df.limit(0)), "k").count() == 0


def test_windows_by_key_keep_the_number_of_tasks(spark):
    from pyspark.sql import Window
    df = by_key(written(spark.range(5_000).select((F.col("id") % 97).alias("k"), "id")), "k", rows=100)
    out = df.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("id")))
    assert out.rdd.getNumPartitions() == 50
