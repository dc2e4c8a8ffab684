"""Credit-rating queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.fixed import CLASS_RATINGS, INVESTMENT_GRADE_MAX_RANK, RATING_RANKS
from ..operators import panel as P
from ..operators import rating as RT
from ..operators import ratios as R
from ..session import cut_lineage
from ..sources import adapters as A
from . import oracle as O
from .q_ratios import ratios_cte
from .registry import register


def L(spark, sf, name):
    return A.load(spark, sf, name)


def _q(s):
    return "'" + s + "'"


_MATCH_CTE = f"""rm AS (
  SELECT q.gvkey, q.datadate, r.rating_rank, r.class_pos, {', '.join('q.' + c for c in RT.RATIO_FEATURES)}
  FROM qd q LEFT JOIN a_rating r ON q.gvkey = r.gvkey AND q.datadate = r.qdate
  WHERE coalesce(r.rating_rank, -1) > -1),
gics1 AS (
  SELECT gvkey, gind FROM (
    SELECT *, row_number() OVER (PARTITION BY gvkey ORDER BY indfrom, gind) AS rn FROM a_gics) t WHERE rn = 1),
feat AS (
  SELECT rm.gvkey, rm.datadate AS qdate, cast(rm.class_pos AS double) AS label,
         {', '.join(f'coalesce(cast({"g." if c == "gind" else "rm."}{c} AS double), 0.0) AS {c}' for c in RT.FEATURES)}
  FROM rm LEFT JOIN gics1 g ON rm.gvkey = g.gvkey)"""


def _rsql(body: str) -> str:
    return O.sql(["a_panelq", "a_rating", "a_gics"], body, ratios_cte("US")[0] + ",\n" + _MATCH_CTE)


def _matched(spark, sf):
    from .q_ratios import prepared_panel
    return RT.rating_match(R.quarterly_ratios(prepared_panel(spark, sf)), L(spark, sf, "a_rating"))


def _features(spark, sf):
    g = P.dedup_first(L(spark, sf, "a_gics"), ["gvkey"], ["indfrom", "gind"])
    return RT.split_flag(RT.features(_matched(spark, sf), g))


def _training_set(spark, sf):
    """Features written once to the shared checkpoint folder: the forest
    makes many passes over them, and a reliable checkpoint both cuts the
    window-heavy lineage and survives lost executors."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return _features(spark, sf).checkpoint(eager=True)


def _model_and_test(spark, sf):
    f = _training_set(spark, sf)
    model = RT.fit(f.filter(~F.col("is_test")))
    return model, f.filter(F.col("is_test"))


def _global_features(spark, sf):
    from .q_ratios import prepared_global
    ratios = R.quarterly_ratios(prepared_global(spark, sf), R.GLOBAL, keep=R.GLOBAL_KEYS)
    return RT.global_features(ratios, L(spark, sf, "a_rating"))


_GLOBAL_CTES, _GLOBAL_RATIOS = ratios_cte("GLB")
_GLOBAL_FEATURE_SQL = ", ".join(
    [f"coalesce(cast({c} AS string), '') AS {c}" for c in RT.GLOBAL_CODES]
    + [f"coalesce(cast(q.{c} AS double), 0.0) AS {c}" for c in RT.GLOBAL_RATIO_FEATURES])

register("rating_features_global", O.sql(["a_panelq_global", "a_gics", "a_rating"], f"""
SELECT q.isin, q.gvkey, q.datadate AS qdate, cast(r.class_pos AS double) AS label, {_GLOBAL_FEATURE_SQL}
FROM {_GLOBAL_RATIOS} q JOIN a_rating r ON q.gvkey = r.gvkey AND q.datadate = r.qdate
WHERE r.rating_rank > -1""", _GLOBAL_CTES))(_global_features)


@register("rating_model_global")
def rating_model_global(spark, sf):
    """Importances of the global forest and how many codes a feature has."""
    train = RT.split_flag(cut_lineage(_global_features(spark, sf)), ("isin", "qdate")).filter(~F.col("is_test"))
    model = RT.fit_global(train)
    codes = dict(zip(RT.GLOBAL_CODES, (len(labels) for labels in model.stages[0].labelsArray)))
    rf = model.stages[-1]
    return spark.createDataFrame(
        [(f, float(v), codes.get(f), rf.getNumTrees) for f, v in zip(RT.GLOBAL_FEATURES, rf.featureImportances.toArray().tolist())],
        "feature string, importance double, n_codes int, num_trees int")


@register("rating_predict_global")
def rating_predict_global(spark, sf):
    """Held-out rows scored from the node table of the global forest."""
    f = cut_lineage(RT.split_flag(_global_features(spark, sf), ("isin", "qdate")))
    model = RT.fit_global(f.filter(~F.col("is_test")))
    return RT.score_model(model, f.filter(F.col("is_test"))).select("isin", "qdate", "label", "prediction")


register("rating_match", _rsql(f"SELECT gvkey, datadate, rating_rank, class_pos, {', '.join(RT.RATIO_FEATURES)} FROM rm"))(
    _matched)

register("rating_features", _rsql(f"SELECT gvkey, qdate, label, {', '.join(RT.FEATURES)} FROM feat"))(
    lambda spark, sf: _features(spark, sf).drop("is_test"))

register("rating_split", _rsql("""
SELECT gvkey, qdate, cast('0x' || substr(md5(gvkey || '|' || cast(qdate AS string)), 1, 8) AS bigint) % 4 = 0 AS is_test FROM feat"""))(
    lambda spark, sf: _features(spark, sf).select("gvkey", "qdate", "is_test"))


@register("rating_model")
def rating_model(spark, sf):
    """Trained forest summarised as feature importances."""
    model, _ = _model_and_test(spark, sf)
    rf = model.stages[-1]
    imp = rf.featureImportances.toArray().tolist()
    return spark.createDataFrame([(f, float(v), rf.getNumTrees) for f, v in zip(RT.FEATURES, imp)],
                                 "feature string, importance double, num_trees int")


@register("rating_predict")
def rating_predict(spark, sf):
    model, test = _model_and_test(spark, sf)
    return model.transform(test).select("gvkey", "qdate", "label", "prediction")


@register("rating_probabilities")
def rating_probabilities(spark, sf):
    model, test = _model_and_test(spark, sf)
    return RT.probabilities(model.transform(test))


@register("rating_top_classes")
def rating_top_classes(spark, sf):
    model, test = _model_and_test(spark, sf)
    return RT.top_classes(model.transform(test))


@register("rating_accuracy")
def rating_accuracy(spark, sf):
    model, test = _model_and_test(spark, sf)
    return RT.accuracy(model.transform(test))


@register("rating_cv")
def rating_cv(spark, sf):
    f = _training_set(spark, sf)
    return RT.cross_validate(f.filter(~F.col("is_test")))


@register("model_roundtrip")
def model_roundtrip(spark, sf):
    model, test = _model_and_test(spark, sf)
    return RT.roundtrip(model, test).select("gvkey", "qdate", "label", "prediction")


_SCALE_VALUES = ", ".join(
    f"({r}, {_q(CLASS_RATINGS[i])}, {_q('Investment-grade' if r <= INVESTMENT_GRADE_MAX_RANK else 'High-yield')})"
    for i, r in enumerate(RATING_RANKS))

register("rating_scale_map", O.sql(["a_rating"], f"""
SELECT r.gvkey, r.qdate, r.rating_rank, s.rating, s.grade
FROM a_rating r LEFT JOIN (VALUES {_SCALE_VALUES}) AS s(rating_rank, rating, grade) ON r.rating_rank = s.rating_rank
WHERE r.rating_rank > -1"""))(lambda spark, sf: RT.scale_map(L(spark, sf, "a_rating")))

register("first_per_group", O.sql(["a_rating"], """
SELECT loc_rank, country_exch FROM (
  SELECT loc_rank, country_exch, row_number() OVER (PARTITION BY loc_rank ORDER BY qdate, gvkey) AS rn
  FROM a_rating) t WHERE rn = 1"""))(
    lambda spark, sf: L(spark, sf, "a_rating").groupBy("loc_rank").agg(
        F.min_by("country_exch", F.struct("qdate", "gvkey")).alias("country_exch")))

register("firms_per_country", O.sql(["a_rating"], """
SELECT loc, count(DISTINCT gvkey) AS n_firms FROM a_rating GROUP BY loc"""))(
    lambda spark, sf: L(spark, sf, "a_rating").groupBy("loc").agg(F.countDistinct("gvkey").alias("n_firms")))
