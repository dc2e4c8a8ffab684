"""Stratified folds: sizes, coverage, repeated runs."""
from collections import Counter

from pyspark.sql import functions as F

from sparkfin.operators import rating as RT


def _rows(spark, n=1000):
    # a third of all rows are one class, one class has a single row
    rows = [(f"g{i}", f"2000-{i % 12 + 1:02d}", 0.0 if i % 3 == 0 else float(i % 7 + 1) if i else 9.0) for i in range(1, n)] + [("x", "2001-01", 50.0)]
    return spark.createDataFrame(rows, "gvkey string, qdate string, label double")


def test_class_counts_of_folds_differ_by_one_at_most(spark):
    df = _rows(spark)
    got = RT.stratified_folds(df, 5).collect()
    assert sorted((r.gvkey, r.qdate, r.label) for r in got) == sorted(map(tuple, df.collect()))
    for label in {r.label for r in got}:
        sizes = Counter(r.fold for r in got if r.label == label)
        counts = [sizes[f] for f in range(5)]
        assert max(counts) - min(counts) <= 1
    again = RT.stratified_folds(df.repartition(3).orderBy(F.desc("gvkey")), 5).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_folds_of_an_empty_table(spark):
    assert RT.stratified_folds(_rows(spark).filter("label > 99"), 5).count() == 0


def test_validation_of_a_rule_that_can_be_learnt(spark):
    rows = [(f"g{i}", f"q{i % 9}", float(i % 3), *([float(i % 3 * 10 + i % 2)] + [0.0] * (len(RT.FEATURES) - 1))) for i in range(300)]
    df = spark.createDataFrame(rows, "gvkey string, qdate string, label double, " + ", ".join(f"{c} double" for c in RT.FEATURES))
    got = RT.cross_validate(df, trees=(5,), k=3).collect()
    assert [(r.num_trees, r.cv_accuracy) for r in got] == [(5, 1.0)]


def _coded(spark, n=240):
    """Labels that depend on a set of codes and one number."""
    names = [f for f in RT.GLOBAL_FEATURES if f not in RT.GLOBAL_CODES]
    rows = [(f"s{i}", "2000", float((i % 7 in (1, 4)) + (i % 5 > 2)), str(i % 7), "" if i % 11 == 0 else f"10{i % 4}",
             float(i % 5), *[float(i * k % 13) for k in range(2, len(names) + 1)]) for i in range(n)]
    return spark.createDataFrame(rows, "isin string, qdate string, label double, loc_rank string, gind string, "
                                 + ", ".join(f"{c} double" for c in names))


def test_global_forest_splits_codes_as_sets(spark):
    df = _coded(spark)
    model = RT.fit_global(df, num_trees=8, max_depth=8)
    nodes = RT.node_table(model).collect()
    codes = {r.feature for r in nodes if r.left_codes}
    assert codes and codes <= {RT.GLOBAL_FEATURES.index(c) for c in RT.GLOBAL_CODES}
    assert all((r.threshold is None) != (r.left_codes is None) for r in nodes if r.feature is not None)
    # a code never seen in training is scored, not refused
    new = df.limit(1).withColumn("loc_rank", F.lit("99"))
    assert RT.score_model(model, new).count() == 1


def test_node_table_scores_like_the_model_and_like_a_recursive_walk(spark):
    import duckdb
    df = _coded(spark)
    model = RT.fit_global(df, num_trees=8, max_depth=8)
    want = {r.isin: (r.probability.toArray().tolist(), r.prediction) for r in model.transform(df).collect()}
    got = {r.isin: (r.probability, r.prediction) for r in RT.score_model(model, df).collect()}
    assert got.keys() == want.keys()
    for k, (p, c) in want.items():
        assert max(abs(a - b) for a, b in zip(got[k][0], p)) < 1e-9
        assert got[k][1] == c or abs(p[int(c)] - p[int(got[k][1])]) < 1e-9
    from pyspark.ml.functions import vector_to_array
    vec = df
    for stage in model.stages[:-1]:
        vec = stage.transform(vec)
    rows = vec.select("isin", vector_to_array("features").alias("x")).toArrow()  # noqa: F841
    nodes = RT.node_table(model).toArrow()  # noqa: F841
    walked = duckdb.sql("""
        WITH RECURSIVE walk AS (
          SELECT isin, x, tree, node FROM rows, nodes WHERE node = 0
          UNION ALL
          SELECT isin, x, n.tree, CASE WHEN coalesce(x[n.feature + 1] <= n.threshold, list_contains(n.left_codes, x[n.feature + 1]))
                 THEN n."left" ELSE n."right" END
          FROM walk w JOIN nodes n USING (tree, node) WHERE n.feature IS NOT NULL)
        SELECT isin, list_sum(list(s0)) / count(*) AS p0 FROM (
          SELECT isin, tree, shares[1] AS s0 FROM walk JOIN nodes USING (tree, node) WHERE feature IS NULL) t GROUP BY isin""").fetchall()
    assert len(walked) == len(got)
    assert all(abs(got[k][0][0] - p0) < 1e-9 for k, p0 in walked)


def test_global_features_of_rows_without_codes_or_ratios(spark):
    names = [f for f in RT.GLOBAL_RATIO_FEATURES]
    ratios = spark.createDataFrame([("i1", "g1", "2000", None, *[None] * len(names)), ("i2", "g2", "2000", "1010", *[1.0] * len(names))],
                                   "isin string, gvkey string, datadate string, gind string, " + ", ".join(f"{c} double" for c in names))
    rating = spark.createDataFrame([("g1", "2000", 3, 2, None), ("g2", "2000", -1, None, 5)],
                                   "gvkey string, qdate string, rating_rank int, class_pos int, loc_rank int")
    (row,) = RT.global_features(ratios, rating).collect()
    assert (row.isin, row.label, row.loc_rank, row.gind) == ("i1", 2.0, "", "")
    assert all(row[c] == 0.0 for c in names)
    assert RT.global_features(ratios.limit(0), rating).count() == 0
