"""Covers, work lists, seeds, windows of streams, extensions of the data model."""

import datetime as dt
import struct

from pyspark.sql import functions as F

from newsloom.operators import dedupe
from newsloom.operators import lifecycle as L
from newsloom.plans import report
from newsloom.schemas import TABLES
from newsloom.sources import files
from newsloom.streaming import ingest

AT = dt.datetime(2024, 3, 1)


def test_schemas_parse(spark):
    for name, ddl in TABLES.items():
        assert spark.createDataFrame([], ddl).columns, name
    assert len(TABLES) == 23


def test_covers(spark, tmp_path):
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", 480, 270) + b"rest"
    for name, data in (("a.png", png), ("b.bin", b"nothing known"), ("c.jpg", b"\xff\xd8\xff\xe0" + b"x" * 50)):
        (tmp_path / name).write_bytes(data)
    got = {r["path"].rpartition("/")[2]: r for r in files.covers(spark, str(tmp_path), most_bytes=1000).collect()}
    assert (got["a.png"]["format"], got["a.png"]["width"], got["a.png"]["height"], got["a.png"]["status"]) == ("png", 480, 270, "ok")
    assert (got["b.bin"]["format"], got["b.bin"]["status"]) == (None, "failed")
    assert got["c.jpg"]["format"] == "jpeg"
    path = spark.range(1).select(files.cover_path(F.lit("abcdef"), F.lit("webp")).alias("p")).first()["p"]
    assert path == "ab/cd/abcdef.webp"
    wanted, present = (spark.createDataFrame([(h,) for h in hs], "cover_hash string") for hs in (["a", "b", None, "a"], ["b"]))
    assert [r[0] for r in files.covers_to_copy(wanted, present).collect()] == ["a"]


def test_update_covers_and_work_lists(spark):
    rows = [(1, "raw", AT, None, "u", "pending", None, None), (2, "enriched", AT, None, "u", "pending", None, None), (3, "enriched", None, "text", None, "pending", None, 5), (4, "discarded", AT, None, "u", "pending", None, None)]
    items = spark.createDataFrame(rows, "id bigint, state string, published timestamp, body string, cover_url string, cover_status string, cover_hash string, assessment_id bigint")
    ids = lambda df: [r["id"] for r in df.collect()]
    assert ids(L.work_list(items, "enrich")) == [1]
    assert ids(L.work_list(items, "enrich", retry=True)) == [1, 2]
    assert ids(L.work_list(items, "cover", limit=1)) == [1]
    assert ids(L.work_list(items, "assess")) == [2]
    results = spark.createDataFrame([(1, "h1", None), (2, None, "timeout")], "id bigint, hash string, error string")
    got = {r["id"]: (r["cover_hash"], r["cover_status"]) for r in L.update_covers(items, results).collect()}
    assert got == {1: ("h1", "ok"), 2: (None, "failed"), 3: (None, "pending"), 4: (None, "pending")}


def test_outlets_upsert_and_dedupe(spark):
    old = spark.createDataFrame([(1, "x.com", "X", "tv", 0.9)], "id bigint, domain string, name string, type string, weight double")
    items = spark.createDataFrame([("x.com",), ("y.com",), ("y.com",), (None,)], "outlet_domain string")
    got = {r["domain"]: (r["type"], r["weight"]) for r in L.with_outlets(old, items).collect()}
    assert got == {"x.com": ("tv", 0.9), "y.com": ("portal", 0.5)}
    new = spark.createDataFrame([("x.com", None, "radio"), ("z.com", "Z", "blog")], "domain string, name string, type string")
    got = {r["domain"]: (r["name"], r["type"], r["weight"]) for r in L.upsert(old, new, "domain", ["name", "type"]).collect()}
    assert got == {"x.com": ("X", "radio", 0.9), "z.com": ("Z", "blog", None)}
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, None)], "k string, n int, v string")
    assert sorted((r["k"], r["n"], r["v"]) for r in dedupe.hard_dedupe(rows, ["k"], ["n"]).collect()) == [("a", 1, "y"), ("b", 3, None)]


def test_seeds(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"limits": {"a": 1}, "name": "x", "list": [1, 2]}')
    assert {r["key"]: r["value"] for r in files.read_config(spark, str(tmp_path / "c.json")).collect()} == {"limits": '{"a":1}', "name": "x", "list": "[1,2]"}
    got = files.seed_vocabulary(spark, {"b": ["x", "y"], "a": ["z"]}).orderBy("topic_position", "word_position").collect()
    assert [(r["topic"], r["word"]) for r in got] == [("b", "x"), ("b", "y"), ("a", "z")]
    (tmp_path / "s.json").write_text('[{"id": 3, "score": 7, "reason": "r", "evidence": ["q"], "confidence": "high"}]')
    assert files.read_scores(spark, str(tmp_path / "s.json")).first()["mention_id"] == 3


def test_stream_windows_equal_batch(spark, tmp_path):
    rows = [(i, AT + dt.timedelta(hours=7 * i)) for i in range(40)]
    spark.createDataFrame(rows, "id bigint, at timestamp").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint, at timestamp").parquet(str(tmp_path / "in"))
    q = ingest.daily_counts(stream, "at").writeStream.format("memory").queryName("daily_windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {str(r["day"]): r["n"] for r in spark.table("daily_windows").collect()}
    want = {}
    for _, at in rows:
        want[str(at.date())] = want.get(str(at.date()), 0) + 1
    assert got == want


def test_extensions(spark):
    numbers = spark.createDataFrame([("visitors", 5.0), ("visitors", 6.0), ("beds", 2.0), ("beds", 2.0)], "indicator string, value double")
    assert [(r["indicator"], r["low"], r["high"]) for r in report.conflicting_numbers(numbers).collect()] == [("visitors", 5.0, 6.0)]
    metrics = spark.createDataFrame([(1, AT, 5), (1, AT + dt.timedelta(days=1), 9), (1, AT + dt.timedelta(days=3), 20)], "id bigint, at timestamp, views int")
    assert report.metric_as_of(metrics, "id", "at", "views", F.lit(AT + dt.timedelta(days=2))).first()["views"] == 9
    same = spark.createDataFrame([(7, 7), (3, 3), (5, 6)], "gold int, model int")
    r = report.calibration(same).first()
    assert (r["n"], r["accuracy"], r["accepted"]) == (3, 1.0, True)
    a = spark.createDataFrame([(2, 5), (1, None)], "id bigint, score int")
    assert report.edition(a).first()["hash"] == report.edition(a.orderBy("id")).first()["hash"]


def test_payload_is_one_document(spark):
    import json

    rows = [(1, "a", "o", AT, "exact", 8, 0, ["x"]), (2, "b", "p", AT + dt.timedelta(days=1), "exact", 3, 2, []), (3, "c", "o", None, "unknown", None, None, None)]
    items = spark.createDataFrame(rows, "id bigint, title string, outlet string, published timestamp, published_precision string, score int, replicas bigint, topics array<string>")
    outlets = spark.createDataFrame([("o", "portal"), ("p", "official"), ("unused", "tv")], "domain string, type string")
    got = json.loads(report.payload(items, outlets, F.lit("2024-03-03").cast("date")).first()["payload"])
    assert got["kpi"] == {"mentions": 3, "mean_score": 5.5, "favourable_pct": 50, "critical": 1, "scored": 2, "pending": 1}
    assert [x["n"] for x in got["days"]] == [1, 1, 0] and [x["domain"] for x in got["outlets"]] == ["o", "p"]
    assert [x["id"] for x in got["items"]] == [2, 1, 3] and [x["r"] for x in got["items"]] == [2, 1, 1]
    assert got["week"]["highlights"] == [2, 1] and got["week"]["attention"] == 2
