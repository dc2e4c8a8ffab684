"""Credit-rating forest: features, split, training, batch scoring.

The forest is grown by ``forest`` (stages of a Spark ML pipeline); a fitted one
is a node table that rows are scored from.
"""
from __future__ import annotations

import math
import os
import uuid

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import (CLASS_RATINGS, INVESTMENT_GRADE_MAX_RANK, RATING_FEATURES_GLB, RATING_FEATURES_US,
                               RATING_RANKS)
from ..session import cut_lineage, ensure_checkpoint_dir
from .forest import ForestClassifier, compact, enter, in_top, subtree_of, walk

FEATURES = RATING_FEATURES_US
RATIO_FEATURES = [f for f in FEATURES if f != "gind"]
GLOBAL_FEATURES = RATING_FEATURES_GLB
GLOBAL_CODES = ["loc_rank", "gind"]          # names, not numbers: country rank and industry
GLOBAL_RATIO_FEATURES = [f for f in GLOBAL_FEATURES if f not in GLOBAL_CODES]
MAX_CODES = 1024                             # a code list is a published standard; more values mean a wrong column


def rating_match(ratios: DataFrame, rating: DataFrame) -> DataFrame:
    """Ratios joined with the rating sample on (firm, quarter); rated rows only."""
    r = rating.select("gvkey", F.col("qdate").alias("datadate"), "rating_rank", "class_pos")
    j = ratios.join(r, ["gvkey", "datadate"], "left")
    return j.filter(F.coalesce("rating_rank", F.lit(-1)) > -1) \
        .select("gvkey", "datadate", "rating_rank", "class_pos", *RATIO_FEATURES)


def features(matched: DataFrame, gics_first: DataFrame) -> DataFrame:
    """Label (class position) and the ten features, missing values as 0."""
    j = matched.join(gics_first.select("gvkey", "gind"), "gvkey", "left")
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in FEATURES]
    return j.select("gvkey", F.col("datadate").alias("qdate"), F.col("class_pos").cast("double").alias("label"),
                    *cols)


def global_features(ratios: DataFrame, rating: DataFrame) -> DataFrame:
    """Label and the ten global features of every rated (security, quarter).

    The eight ratios are numbers, missing values 0; country rank and industry
    are codes, a missing one the empty text, which is a category of its own."""
    r = rating.select("gvkey", F.col("qdate").alias("datadate"), "rating_rank", "class_pos", "loc_rank")
    j = ratios.join(r, ["gvkey", "datadate"], "left").filter(F.coalesce("rating_rank", F.lit(-1)) > -1)
    return j.select("isin", "gvkey", F.col("datadate").alias("qdate"), F.col("class_pos").cast("double").alias("label"),
                    *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in GLOBAL_CODES],
                    *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in GLOBAL_RATIO_FEATURES])


def split_flag(df: DataFrame, keys=("gvkey", "qdate")) -> DataFrame:
    """Stable 25 % test split from a digest of the key (no random state, so
    reruns and lost executors give the same split, and any key will do)."""
    digest = F.md5(F.concat_ws("|", *keys).cast("binary"))
    return df.withColumn("is_test", F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 4 == 0)


def fit(train: DataFrame, num_trees: int = 100, max_depth: int = 30, seed: int = 0):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    va = VectorAssembler(inputCols=FEATURES, outputCol="features")
    rf = ForestClassifier(numTrees=num_trees, maxDepth=max_depth, maxBins=64, seed=seed)
    return Pipeline(stages=[va, rf]).fit(train)


def fit_global(train: DataFrame, num_trees: int = 100, max_depth: int = 30, seed: int = 0):
    """The global forest: country rank and industry are split as sets of
    codes, not as numbers.  Bins hold every code of the training rows (and one
    for codes not seen there), at least 64."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    seen = train.agg(*[F.approx_count_distinct(c).alias(c) for c in GLOBAL_CODES]).first()
    if max(seen) > MAX_CODES:
        raise ValueError(f"more than {MAX_CODES} codes in {GLOBAL_CODES}: {seen}")
    codes = StringIndexer(inputCols=GLOBAL_CODES, outputCols=[c + "_index" for c in GLOBAL_CODES],
                          handleInvalid="keep", stringOrderType="alphabetAsc").fit(train)
    bins = max(64, *(len(labels) + 1 for labels in codes.labelsArray))
    va = VectorAssembler(inputCols=[c + "_index" if c in GLOBAL_CODES else c for c in GLOBAL_FEATURES], outputCol="features")
    rf = ForestClassifier(numTrees=num_trees, maxDepth=max_depth, maxBins=bins, seed=seed, codes={
        GLOBAL_FEATURES.index(c): len(labels) + 1 for c, labels in zip(GLOBAL_CODES, codes.labelsArray)})
    return Pipeline(stages=[codes, va, rf]).fit(train)


def node_table(model) -> DataFrame:
    """A fitted forest as a table, one row per node: ``tree``, ``node``,
    ``feature`` (its place in the vector), ``threshold`` (a number: values up to
    it go left), ``left_codes`` (a code: these go left), ``left``, ``right`` and
    ``shares`` (a leaf's class shares of its training rows).  A leaf has no
    feature and is its own child, so a walk may go on past it; ``depth`` is the
    node's level."""
    return model.stages[-1].nodes


def score_nodes(nodes: DataFrame, df: DataFrame, vector: str = "features") -> DataFrame:
    """``df`` with ``probability`` (an array over the classes) and
    ``prediction``, from a node table.

    A row enters every tree at its root and goes through the tops of all trees
    in one pass (the top's few nodes go to the tasks, as they do while the forest
    grows); then rows and nodes are dealt once by (tree, subtree) and a task takes
    the rows, as they stream in, to their leaves.  Of classes whose
    shares agree to nine places the first is predicted, so the order of the sums
    does not matter."""
    from pyspark.ml.functions import vector_to_array
    trees, classes, size = nodes.agg(F.max("tree"), F.max(F.size("shares")), F.count(F.lit(1))).first()
    if trees is None:
        raise ValueError("no nodes")
    top = nodes.filter(in_top()).select("tree", "node", *compact()).toArrow()
    ends = {f: np.sort(v) for f, v in nodes.filter(F.col("threshold").isNotNull()).groupBy("feature").agg(F.collect_set("threshold")).collect()}   # at most ``bins`` a feature
    rows = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    vectors = rows.select("_row", vector_to_array(vector).alias("_x"))
    n, width = vectors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("_x")), F.lit(1))).first()
    below = nodes.filter(~in_top()).select("tree", subtree_of().alias("part"), F.lit(0).alias("kind"), "node", *compact())
    spark = df.sparkSession
    dealt = vectors.select("_row", *[F.get("_x", F.lit(i)).alias(f"_x{i}") for i in range(width)]) \
        .repartition(max(spark.sparkContext.defaultParallelism, math.ceil(n / 20_000)))
    entered = dealt.mapInArrow(enter(top, trees + 1, ends), "tree int, part bigint, kind int, node bigint, x binary")
    tasks = max(4 * spark.sparkContext.defaultParallelism, math.ceil((size + n * (trees + 1)) / 1_000_000))
    met = below.unionByName(entered, allowMissingColumns=True).repartition(tasks, "tree", "part").sortWithinPartitions("tree", "part", "kind")
    shares = met.mapInArrow(walk(classes, width, ends), "_row bigint, class int, share double").groupBy("_row", "class").agg(F.sum("share").alias("share"))
    found = shares.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("class", "share"))).alias("_m"))     # one entry a class
    votes = found.select("_row", F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: F.coalesce(F.try_element_at("_m", i), F.lit(0.0))).alias("_s"))
    near = F.transform("_s", lambda x: F.round(x, 9))
    total = F.aggregate("_s", F.lit(0.0), lambda a, x: a + x)
    votes = votes.withColumn("_t", total).select("_row", F.transform("_s", lambda x: x / F.col("_t")).alias("probability"),
                         (F.array_position(near, F.array_max(near)) - 1).cast("double").alias("prediction"))
    return rows.join(votes, "_row").drop("_row")


def score_model(model, df: DataFrame) -> DataFrame:
    """A fitted pipeline's forest applied through its node table: the stages
    before it make the vector, ``score_nodes`` the prediction."""
    for stage in model.stages[:-1]:
        df = stage.transform(df)
    return score_nodes(node_table(model), df)


def _class_col(i: int) -> str:
    return "p_" + CLASS_RATINGS[i].replace("+", "_plus").replace("-", "_minus")


def probabilities(scored: DataFrame) -> DataFrame:
    """Class probabilities as whole percents (truncated), one column per class."""
    from pyspark.ml.functions import vector_to_array
    p = vector_to_array("probability")
    n = len(CLASS_RATINGS)
    return scored.select("gvkey", "qdate", *[
        F.coalesce(F.floor(F.try_element_at(p, F.lit(i + 1)) * 100), F.lit(0)).cast("int").alias(_class_col(i))
        for i in range(n)])


def top_classes(scored: DataFrame, k: int = 3) -> DataFrame:
    """The k most probable classes with their probabilities."""
    from pyspark.ml.functions import vector_to_array
    p = vector_to_array("probability")
    names = F.array(*[F.lit(c) for c in CLASS_RATINGS])
    z = F.arrays_zip(p.alias("prob"), F.slice(names, 1, F.size(p)).alias("rating"))
    top = F.slice(F.sort_array(z, asc=False), 1, k)
    return scored.select("gvkey", "qdate", top.alias("top_classes"))


def accuracy(scored: DataFrame) -> DataFrame:
    """Hold-out accuracy next to the majority-class share (one scalar from
    a per-class count table, at most one row per class)."""
    m = scored.groupBy("label").count().agg(F.max("count"), F.sum("count")).first()
    share = float(m[0]) / float(m[1]) if m and m[1] else None
    return scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
                      F.count("*").alias("n_test")).withColumn("majority_share", F.lit(share).cast("double"))


def scale_table(spark) -> DataFrame:
    """Static rank -> rating -> grade table (22 rows)."""
    rows = [(r, CLASS_RATINGS[i], "Investment-grade" if r <= INVESTMENT_GRADE_MAX_RANK else "High-yield")
            for i, r in enumerate(RATING_RANKS)]
    return spark.createDataFrame(rows, "rating_rank int, rating string, grade string")


def scale_map(rating: DataFrame) -> DataFrame:
    st = F.broadcast(scale_table(rating.sparkSession))   # fixed 22 rows
    return (rating.filter(F.col("rating_rank") > -1).join(st, "rating_rank", "left")
            .select("gvkey", "qdate", "rating_rank", "rating", "grade"))


def stratified_folds(df: DataFrame, k: int = 5, keys=("gvkey", "qdate"), label: str = "label") -> DataFrame:
    """Fold 0..k-1 of every row: inside each class the rows, in the order of a
    hash of their keys, go to the folds in turn, so a class's folds differ by
    one row at most.

    The rank inside a class is distributed: rows are range-sorted by (class,
    hash), and a row's rank is its place in its partition plus the rows of its
    class in the partitions before, from one count per partition and class."""
    h = df.withColumn("_h", F.xxhash64(*keys))
    cut = cut_lineage(h.repartitionByRange(label, "_h", *keys).sortWithinPartitions(label, "_h", *keys))
    placed = cut.withColumn("_at", F.monotonically_increasing_id()) \
        .withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    placed = cut_lineage(placed)
    per = placed.groupBy("_part", F.col(label).alias("_class")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_class").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = per.select("_part", "_class", (before - F.col("_first")).alias("_shift"))
    same = (placed["_part"] == per["_part"]) & placed[label].eqNullSafe(per["_class"])
    rank = F.col("_at") + F.col("_shift")
    return placed.join(per, same).withColumn("fold", F.pmod(rank, F.lit(k)).cast("int")).select(*df.columns, "fold")


def cross_validate(train: DataFrame, trees=(100,), k: int = 5, seed: int = 0) -> DataFrame:
    """Mean accuracy over ``k`` stratified folds.  The folds' forests do not
    wait for each other: they are fitted at the same time, so the levels of one
    fill the cluster while another plans its next."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    folded = cut_lineage(stratified_folds(train, k))
    spark = train.sparkSession

    def measured(job):
        n, fold = job
        held = fit(folded.filter(F.col("fold") != fold), num_trees=n, seed=seed).transform(folded.filter(F.col("fold") == fold))
        return held.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    jobs = [(n, f) for n in trees for f in range(k)]
    with ThreadPoolExecutor(k) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(measured), jobs))
    rows = [(int(n), sum(a for (m, _), a in zip(jobs, found) if m == n and a is not None) / max(1, sum(
        m == n and a is not None for (m, _), a in zip(jobs, found)))) for n in trees]
    return spark.createDataFrame(rows, "num_trees int, cv_accuracy double")


def roundtrip(model, df: DataFrame) -> DataFrame:
    """Save the fitted pipeline to the shared checkpoint folder, load it
    back and score with the loaded copy."""
    from pyspark.ml import PipelineModel
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), "models", uuid.uuid4().hex)
    model.write().overwrite().save(path)
    return PipelineModel.load(path).transform(df)
