"""Mixing and archive: oracles, exact quotas, round trips, edge rows."""
import base64
import hashlib

import duckdb
import pyspark.sql.functions as F
import pytest

from llm_fixtures import SF_CHECK, docs, empty, rows  # noqa: F401
from sparkfin.llm import mixing, warc
from sparkfin.llm.shared import run_folder


def test_mix_quotas_and_bounds(docs, rows):
    r, dealt = mixing.mix(docs)
    out = mixing.taken(r, dealt).collect()
    assert len(out) == len(rows)
    words = {}
    for x in out:
        assert 0 <= x.taken <= 3 * x["size"]
        words.setdefault(x.source, [x.source_size, x.target, 0, 0])
        words[x.source][2] += x.taken
        words[x.source][3] += x["size"]
    assert all(v[0] == v[3] and int(v[1]) == v[2] for v in words.values())
    total = sum(v[0] for v in words.values())
    assert sum(v[1] for v in words.values()) == pytest.approx(total)
    again = mixing.taken(*mixing.mix(docs)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_shards_hold_exact_halves(docs, spark):
    _, dealt = mixing.mix(docs, levels=2)
    n = {x.shard: x["count"] for x in dealt.select("place", "block", "round", "shard").distinct().groupBy("shard").count().collect()}
    assert set(n) <= set(range(4)) and max(n.values()) - min(n.values()) <= 2
    assert dealt.groupBy("place", "block", "round").agg(F.count_distinct("shard").alias("k")).filter("k > 1").isEmpty()
    path = run_folder(spark, "shards")
    mixing.write_shards(dealt, path)
    assert spark.read.parquet(path).agg(F.sum("words")).first()[0] == dealt.agg(F.sum("words")).first()[0]


def shard_words(spark, sf):
    rows, dealt = mixing.mix(spark.read.parquet(f"{sf}/documents.parquet"))
    return sorted((r.id, r.taken, r.shard_words) for r in mixing.taken(rows, dealt).collect())


def test_the_tree_decides_the_shards(spark, monkeypatch):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF_CHECK}/documents.parquet')")
    want = sorted(con.sql(f"select doc_id, taken, shard_words from ({mixing.ORACLE.strip()})").fetchall())
    assert shard_words(spark, SF_CHECK) == want
    assert all(t == sum(map(int, w.split(","))) for _, t, w in want)

    def round_robin(drawn, levels=3):
        sizes = F.array(*(F.floor(F.col("drawn") * (j + 1) / 2 ** levels) for j in range(2 ** levels)))
        return drawn.select("place", "drawn").distinct().select("place", sizes.alias("ends"))
    monkeypatch.setattr(mixing, "shard_quotas", round_robin)
    other = shard_words(spark, SF_CHECK)
    assert other != want and [x[:2] for x in other] == [x[:2] for x in want]


def test_a_node_is_halved_by_a_hypergeometric_draw(spark):
    n = {0: 3000, 1: 1000, 2: 1}
    drawn = spark.createDataFrame(list(n.items()), "place long, drawn long")
    ends = {r.place: r.ends for r in mixing.shard_quotas(drawn, levels=2).collect()}
    assert {p: e[-1] for p, e in ends.items()} == n
    at = [sum(e[j] for e in ends.values()) for j in range(4)]
    assert at[1] == 4001 // 2 and abs(at[0] - 1000) <= 1 and abs(at[2] - 3000) <= 1
    sd = (2000 * 0.75 * 0.25 * 2000 / 4000) ** 0.5
    assert 0 < abs(ends[0][1] - 1500) < 5 * sd


def test_targets_stop_at_the_cap(spark):
    df = spark.createDataFrame([(i, "w " * n, "x", s) for i, (s, n) in enumerate([("a", 1000), ("b", 10), ("c", 20)])],
                               "doc_id long, text string, lang string, source string")
    got = {x.source: x.target for x in mixing.targets(mixing.sized(df)).collect()}
    assert got == {"a": 940.0, "b": 30.0, "c": 60.0}


def test_empty_mix(empty):
    assert mixing.taken(*mixing.mix(empty)).count() == 0


PAGES = [(5, "http://a/", "<p>é</p>"), (3, "http://b/", "<p>é</p>"), (1, None, None), (2, "http://c/\r\nX: y", ""), (9, "http://d/", "a\r\n\r\nWARC/1.1\r\nb"),
         (None, "http://e/", "<p>é</p>"), (9, "http://d/", "a\r\n\r\nWARC/1.1\r\nb"), (12, "u", "z" * 200000)]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'clash' as id", "'c' as payload", "'c' as address", "'c' as row")


def test_archive_round_trip(spark, pages):
    path = run_folder(spark, "warc-test")
    warc.write_archive(pages, path)
    assert spark.read.parquet(path + "/payloads").count() == 4
    got = warc.read_archive(spark, path).collect()
    assert sorted(((r.id, bytes(r.payload).decode()) for r in got), key=str) == sorted(((p[0], p[2] or "") for p in PAGES), key=str)
    first = {"<p>é</p>": 3, "": 1}
    for r in got:
        body = bytes(r.payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode() and r.payload_bytes == len(body)
        source = first.get(body.decode(), r.id)
        assert (r.record_type, r.refers_to) == (("response", None) if r.id == source else ("revisit", str(source)))
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        assert head.count(b"\r\nX: ") == 0 and rest == (body if r.record_type == "response" else b"") + b"\r\n\r\n"
    warc.write_warc_files(warc.read_archive(spark, path), path + "/files", per_file=2)
    back = warc.read_warc_files(spark, path + "/files").collect()
    want = [(r.header, bytes(r.payload) if r.record_type == "response" else b"") for r in got]
    assert sorted((r.header, bytes(r.payload)) for r in back) == sorted(want)


def test_damage_is_found(spark, pages):
    path = run_folder(spark, "warc-test")
    warc.write_archive(pages, path)
    bad = spark.read.parquet(path + "/payloads").withColumn("payload", F.concat("payload", F.lit(b"x")))
    bad.write.parquet(path + "-bad/payloads")
    spark.read.parquet(path + "/records").write.parquet(path + "-bad/records")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archive(spark, path + "-bad").collect()


def test_empty_archive(spark, pages):
    path = run_folder(spark, "warc-test")
    warc.write_archive(pages.limit(0), path)
    assert warc.read_archive(spark, path).count() == 0


def test_rebuilt_record_is_checked(spark, pages):
    path = run_folder(spark, "warc-test")
    warc.write_archive(pages, path)
    bad = spark.read.parquet(path + "/records").withColumn("header", F.regexp_replace("header", "Content-Length: ", "Content-Length: 1"))
    bad.write.parquet(path + "-bad/records")
    spark.read.parquet(path + "/payloads").write.parquet(path + "-bad/payloads")
    with pytest.raises(Exception, match="damaged record"):
        warc.read_archive(spark, path + "-bad").select("payload_digest").collect()
