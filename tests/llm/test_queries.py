"""Registered queries: oracles on the small tables, the pipeline step by step."""
import duckdb
import pytest

import corpus_pipeline
from llm_fixtures import SF_CHECK, SF_SMALL, frame, rows  # noqa: F401
from sparkfin.llm import decontaminate, queries


@pytest.fixture(scope="module")
def con():
    from sparkfin.sources.tables import TABLES
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracles(spark, con, name):
    got = queries.queries()[name](spark, SF_SMALL)
    want = con.sql(queries.oracle_sql()[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)

    def norm(row):
        return tuple(round(v, 6) if isinstance(v, float) else v for v in row)
    at = [want.columns.index(c) for c in cols]
    assert sorted(map(str, (norm(r) for r in got.select(cols).collect()))) == sorted(map(str, (norm(r[i] for i in at) for r in want.fetchall())))


def test_registered_once_each():
    import __spark_entry__ as E
    names = [n for n in E.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()


def test_pipeline_stages(spark):
    from sparkfin.llm.shared import written
    from test_near_dup import brute as near
    from test_substring_dedup import brute as repeats
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    stage = dict(corpus_pipeline.STAGES)
    kept = written(stage[names[0]](spark, docs, SF_CHECK), "t")
    assert kept.columns == docs.columns and kept.count() > 0.97 * docs.count()

    rows = [(r.doc_id, r.text) for r in kept.collect()]
    once = written(stage[names[1]](spark, kept, SF_CHECK), "t")
    assert sorted(r.doc_id for r in once.collect()) == sorted(i for i, _, root in near(rows, 5) if i == root)

    rows = [(r.doc_id, r.text) for r in once.collect()]
    less = written(stage[names[2]](spark, once, SF_CHECK), "t")
    assert less.columns == docs.columns and {r.doc_id: len(r.text.split()) for r in less.collect()} == {i: n - gone for i, n, gone, _ in repeats(rows)}

    clean = written(stage[names[3]](spark, less, SF_CHECK), "t")
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{SF_CHECK}/benchmark.parquet").collect()]
    text = {r.doc_id: decontaminate.normal(r.text) for r in less.collect()}
    gone = set(text) - {r.doc_id for r in clean.collect()}
    assert {i for i, t in text.items() if any(x in t for x in items)} <= gone and len(gone) < 0.1 * len(text)

    mix = stage[names[4]](spark, clean, SF_CHECK).collect()
    by = {}
    for r in mix:
        by.setdefault(r.source, [r.target, 0])[1] += r.taken
    assert len(mix) == clean.count() and all(int(a) == b for a, b in by.values())


def test_pipeline_edges(spark, rows, tmp_path):
    for i, data in enumerate((rows, [])):
        d = tmp_path / str(i)
        frame(spark, data, clash=True).write.parquet(str(d / "documents.parquet"))
        spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").write.parquet(str(d / "benchmark.parquet"))
        out = corpus_pipeline.run(spark, str(d))
        assert (out.count() > 0) == bool(data)


def test_clean_rows_beside_contaminated_rows(spark, tmp_path):
    item = "the quick brown fox jumps over the lazy dog while seven wizards look on"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = "an entirely different document about the price of tea"
    rows = [(None, item, "en", "s"), (None, clean, "en", "s"), (None, None, "en", "s"), (1, "so " + item, "en", "s"), (1, clean, "en", "s"),
            (1, clean, "en", "s"), (2, clean, "en", "s"), (2, "x " + item + " y", "en", "s")]
    got = corpus_pipeline.decontaminated(spark, frame(spark, rows), str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(r[0], r[1]) for r in rows if item not in (r[1] or "")], key=str)
