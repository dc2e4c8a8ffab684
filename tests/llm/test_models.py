"""Language ID and classifiers: held-out accuracy on the small tables, edge rows."""
import random

import numpy as np
import pyspark.sql.functions as F
import pytest

from llm_fixtures import SF_CHECK, docs, empty, rows  # noqa: F401
from sparkfin.llm import lang_id, quality, queries, toxicity


def table(spark, name):
    return spark.read.parquet(f"{SF_CHECK}/{name}.parquet")


def test_language_accuracy(spark):
    got = queries.op1_language_id(spark, SF_CHECK).cache()
    docs = got.filter("doc_id is not null").join(table(spark, "documents").select("doc_id", F.col("lang").alias("truth")), "doc_id")
    assert docs.count() == table(spark, "documents").count()
    assert docs.agg(F.avg((F.col("lang") == F.col("truth")).cast("int"))).first()[0] > 0.97
    pages = got.filter("page_id is not null").join(
        table(spark, "pages").select("page_id", F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("truth")), "page_id")
    assert pages.count() == table(spark, "pages").count()
    assert pages.agg(F.avg((F.col("lang") == F.col("truth")).cast("int"))).first()[0] > 0.97


def evidence(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, markup boolean, declared string, suffix string, host string, domain string")


def model(spark):
    en, de = "the cat and the dog went over the hill ", "der hund und die katze gingen auf den berg "
    rows = [("en", en * 4, False), ("de", de * 4, False), (None, "x", False), ("en", None, False)]
    return lang_id.fit(spark.createDataFrame(rows, "label string, text string, markup boolean"))


def test_evidence_is_fused(spark):
    m = model(spark)
    assert m[0] == ["de", "en"]
    rows = [(i, "the dog and the cat", False, "en", "uk", "a.co.uk", "co.uk") for i in range(30)]
    rows += [(100 + i, "der hund und die katze", False, "de", "de", "b.de", "b.de") for i in range(30)]
    rows += [(200, "zzz", False, "de", "de", "b.de", "b.de"), (201, "zzz", False, "en", "uk", "a.co.uk", "co.uk"), (202, None, False, "de", None, None, None),
             (203, "", False, None, None, None, None), (204, "123 456", False, None, None, "b.de", "b.de"), (None, "the cat", False, None, None, None, None)]
    got = {r.doc_id: r for r in lang_id.identify(evidence(spark, rows), m).collect()}
    assert got[200].lang == "de" and got[201].lang == "en" and got[202].lang == "de" and got[204].lang == "de" and got[None].lang == "en"
    assert not any(got[i].accepted for i in (202, 203, 204)) and got[200].accepted and len(got) == 66


def test_language_edges(spark, docs, empty, rows):
    m = model(spark)
    assert lang_id.identify(evidence(spark, []), m).count() == 0
    none = lang_id.fit(spark.createDataFrame([], "label string, text string, markup boolean"))
    got = lang_id.identify(evidence(spark, [(1, "the cat", False, None, None, None, None)]), none).first()
    assert got.lang is None and not got.accepted
    e = lang_id.document_evidence(docs.drop("id")).select("doc_id", "text", "markup", "declared", "suffix", "host", "domain")
    assert lang_id.identify(e, m).count() == len(rows)


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_accuracy(spark, module, label):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    got = module.score(docs, module.fit(docs, labels)).join(labels.withColumnRenamed("doc_id", "id"), "id").filter("held_out").toPandas()
    assert len(got) > 50 and got["score"].between(0, 1).all()
    assert (got["predicted"] == got[label]).mean() > 0.93


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifier_edges(spark, docs, rows, empty, module, label):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(25)] + [(None, 1, 1), (3, None, None), (77777, 0, 1)], "doc_id long, quality int, toxic int") \
        .selectExpr("*", "1 as lid", "2 as y", "3 as text")
    m = module.fit(docs, labels)
    got = module.score(docs, m).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert module.score(empty, m).count() == 0
    one = module.fit(docs, labels.filter(f"{label} = 1"))
    assert {r.score for r in module.score(docs, one).collect()} == {1.0}
    none = module.fit(docs, labels.limit(0))
    assert {r.score for r in module.score(docs, none).collect()} == {0.5}


def test_machine_weighs_pairs():
    m = toxicity.Machine([1, 2, 3], 0.5, np.array([1.0, 2.0, 0.0]), np.array([[1.0, 0.0], [2.0, 1.0], [0.0, 1.0]]))
    assert m.raw([0, 1]) == pytest.approx(0.5 + 3 + 2) and m.raw([1, 2]) == pytest.approx(0.5 + 2 + 1) and m.raw([]) == 0.5


def test_cut_between_classes():
    assert 0.2 < quality.cut_quantile(np.array([0.1, 0.9, 0.2, 0.8]), np.array([0, 1, 0, 1])) < 0.8


def test_copies_of_a_text_are_sampled_once(spark):
    rows = [(x, f"{w} number {i}", False) for x, w in (("en", "the cat sat"), ("de", "der hund sass")) for i in range(15)]
    df = spark.createDataFrame(rows, "label string, text string, markup boolean")
    first = df.orderBy(F.xxhash64("text"), "label").limit(1)
    many = df.unionByName(first.crossJoin(spark.range(200)).drop("id"))
    names, logs = lang_id.fit(many, sample_rows=25)
    names2, logs2 = lang_id.fit(df, sample_rows=25)
    assert names == names2 == ["de", "en"] and (logs == logs2).all()


def test_unlabelled_script_and_junk_are_not_accepted(spark):
    labelled = table(spark, "documents").select(F.col("lang").alias("label"), "text", F.lit(False).alias("markup"))
    m = lang_id.fit(labelled)
    known = [(i, r.text, False, None, None, None, None) for i, r in enumerate(labelled.filter("label is not null").limit(50).collect())]
    rng = np.random.default_rng(0)
    junk = " ".join("".join(map(chr, rng.integers(97, 123, 9))) for _ in range(60))
    other = [(100, "это предложение написано на языке которого нет в таблице " * 4, False, None, None, None, None),
             (101, "αυτή η πρόταση είναι γραμμένη σε άλλη γλώσσα", False, None, None, None, None), (102, junk, False, None, None, None, None)]
    got = {r.doc_id: r.accepted for r in lang_id.identify(evidence(spark, known + other), m).collect()}
    assert all(got[i] for i in range(len(known))) and not got[100] and not got[101] and not got[102]


def test_sample_bound_holds_for_repeated_ids(spark):
    many = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 50).cast("string")).alias("text"))
    docs = many.unionByName(spark.createDataFrame([(3, "other"), (4, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    assert quality.sample_rows(docs, labels, "quality", 10).count() == 10
    assert quality.sample_rows(docs, labels, "quality", 1000).count() == 51 + int(not docs.filter("doc_id = 4").select(quality.held_out(F.col("doc_id"))).first()[0])


def test_pair_whose_parts_tell_nothing_is_learnt(spark):
    r = random.Random(5)
    noise = ["".join(r.choices("bcdfghjklm", k=7)) for _ in range(6000)]
    rows = []
    for i in range(6000):
        a, b = r.random() < 0.5, r.random() < 0.5
        words = r.sample(noise, 20) + ["zorba"] * a + ["quexi"] * b
        r.shuffle(words)
        rows.append((i, " ".join(words), int(a != b)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    m = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert {toxicity.bucket("zorba"), toxicity.bucket("quexi")} <= set(m.at)
    got = toxicity.score(df.select("doc_id", "text"), m).join(df.select(F.col("doc_id").alias("id"), "toxic"), "id").filter("held_out")
    assert got.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0] >= 0.9


def test_pair_gains_against_counting():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2, (200, 4)).astype(np.float32)
    y = (x[:, 0] != x[:, 1]).astype(np.int64)
    gain = toxicity.pair_gains(x, y)

    def g(cell):
        return sum(n * np.log(n * len(y) / ((cell == c).sum() * (y == k).sum()))
                   for c in np.unique(cell) for k in (0, 1) if (n := ((cell == c) & (y == k)).sum()))
    want = g(2 * x[:, 0] + x[:, 1]) - g(x[:, 0]) - g(x[:, 1])
    assert gain[0, 1] == pytest.approx(want) and gain.max() == gain[0, 1] > 100


def test_language_ids_may_have_any_name(spark):
    m = model(spark)
    e = evidence(spark, [(1, "the dog and the cat", False, "en", "uk", "a.co.uk", "co.uk")])
    names = ("n", "ll", "post", "fused", "final", "even", "row", "id", "all_n", "host_n", "host_c", "host_prior", "log_declared", "s0", "c0")
    got = lang_id.identify(e.selectExpr("*", "'x' as lang", *(f"'{c}' as {c}" for c in names)), m).first().asDict()
    assert got["doc_id"] == 1 and got["lang"] == "en" and all(got[c] == c for c in names)
    assert lang_id.identify(e.drop("doc_id"), m).first().lang == "en"
