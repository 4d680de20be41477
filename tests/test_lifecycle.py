"""Lifecycle operators, files, feeds and streams on hand-made rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from newsloom.operators import lifecycle as L
from newsloom.plans import report
from newsloom.schemas import TABLES, split_valid
from newsloom.sources import feeds, files
from newsloom.streaming import ingest

AT = dt.datetime(2024, 3, 1)
WORDS = {"port": ["porto"]}


def items(spark, rows):
    return spark.createDataFrame(rows, "id bigint, title string, summary string, body string, state string, discard_reason string, published timestamp, published_precision string, author string, cover_url string, assessment_id bigint")


def row(i, title, state="raw", reason=None, summary=None, body="b"):
    return (i, title, summary, body, state, reason, AT, "approximate", None, None, None)


def test_ingest(spark):
    raw = spark.createDataFrame([("a", "porto x", None, "http://x.com/1?utm_id=3"), ("b", "porto y", None, "https://www.x.com/1"), ("c", "nothing", None, None), ("d", "porto z", None, None), ("e", "porto old", None, "https://x.com/old")], "gid string, title string, summary string, url string")
    stored = spark.createDataFrame([("press", "https://x.com/old")], "channel string, u string").select("channel", F.sha1(F.col("u").cast("binary")).alias("dedupe_hash"))
    got = L.ingest(raw, stored, ["porto"], [])
    assert {r["outcome"]: r["n"] for r in L.outcomes(got).collect()} == {"new": 1, "repeated": 1, "noise": 1, "no-url": 1}
    assert got.where("outcome = 'new'").first()["gid"] == "a"


def test_first_of_equal_gids_is_that_of_the_least_place(spark):
    raw = spark.createDataFrame([(g, "porto", f"https://x.com/{g}", p) for g, places in (("a", (9, 3, 5)), ("b", (2, 8, 4)), ("c", (7, 6, 1))) for p in places], "gid string, title string, url string, place bigint").coalesce(1)
    none = spark.createDataFrame([], "channel string, dedupe_hash string")
    assert {r["gid"]: r["place"] for r in L.ingest(raw, none, ["porto"], []).collect()} == {"a": 3, "b": 2, "c": 1}


def test_enrich_retag_reset(spark):
    base = items(spark, [row(1, "porto"), row(2, "esporte"), row(3, "porto"), row(4, "x", "discarded", L.OFF_TOPIC, "porto")])
    pages = spark.createDataFrame([(1, None, "t", "new summary", "Ana", "c.png", AT, "text"), (2, None, "t", None, None, None, None, None), (3, "http 403", None, None, None, None, None, None)], "id bigint, error string, title string, summary string, author string, cover string, published timestamp, body string")
    got = {r["id"]: r for r in L.enrich(base, pages, WORDS).collect()}
    assert (got[1]["state"], got[1]["summary"], got[1]["published_precision"], got[1]["body"]) == ("enriched", "new summary", "exact", "text")
    assert (got[2]["state"], got[2]["discard_reason"], got[2]["body"]) == ("discarded", L.OFF_TOPIC, None)
    assert (got[3]["state"], got[3]["body"]) == ("enriched", "b")
    assert got[4]["state"] == "discarded"
    again = {r["id"]: (r["state"], r["discard_reason"]) for r in L.retag(base, WORDS).collect()}
    assert again == {1: ("raw", None), 2: ("discarded", L.OFF_TOPIC), 3: ("raw", None), 4: ("discarded", L.OFF_TOPIC)}
    back = {r["id"]: (r["state"], r["body"]) for r in L.reset(items(spark, [row(1, "a", "enriched"), row(2, "a", "discarded", L.NOISE), row(3, "a", "discarded", L.OFF_TOPIC)])).collect()}
    assert back == {1: ("raw", None), 2: ("discarded", "b"), 3: ("raw", None)}


def test_assess_and_point(spark):
    base = items(spark, [row(1, "porto novo", "enriched"), row(2, "x", "discarded")])
    scores = spark.createDataFrame([(1, 12, "r" * 500, ["PORTO novo"], "high"), (9, 3, "r", [], None)], "mention_id bigint, score int, reason string, evidence array<string>, confidence string")
    got = L.assess(base, scores, 1, F.lit(AT), clamp=True)
    assert [(r["mention_id"], r["score"], len(r["reason"]), r["confidence"]) for r in got.collect()] == [(1, 10, 400, "high")]
    _, rejected = split_valid(L.assess(base, scores, 1, F.lit(AT)), "assessment")
    assert rejected.count() == 1
    pointed = {r["id"]: r["state"] for r in L.point_at(base, got).collect()}
    assert pointed == {1: "assessed", 2: "discarded"}


def test_auto_assess(spark):
    def scorer(frames):
        for f in frames:
            yield f.assign(mention_id=f.id, score=11, reason="r", evidence=[["porto"]] * len(f), confidence="high", tokens_in=1000, tokens_out=100, error=None)[["mention_id", "score", "reason", "evidence", "confidence", "tokens_in", "tokens_out", "error"]]

    rows, counters = L.auto_assess(items(spark, [row(1, "porto", "enriched"), row(2, "b", "raw")]), scorer, 1, F.lit(AT))
    assert [(r["mention_id"], r["score"], r["cost"]) for r in rows.collect()] == [(1, 10, 0.0015)]
    assert counters.first().asDict() == {"ok": 1, "failed": 0, "cost": 0.0015}
    assert L.run_failed(0, 1) and L.run_failed(1, 2) and not L.run_failed(2, 2) and not L.run_failed(0, 0)


def test_rubric_versions(spark):
    old = spark.createDataFrame([], "hash string, text string, prompt string, model string, bands string, valid_from date, version string")
    one = L.rubric_versions(old, "t", "p", "m", "{}", F.lit(AT))
    same = L.rubric_versions(one, "t", "p", "m", "{}", F.lit(AT))
    two = L.rubric_versions(same, "t2", "p", "m", "{}", F.lit(AT))
    assert sorted(r["version"] for r in two.collect()) == ["v1.0", "v1.1"]


def test_compaction(spark):
    rows = spark.createDataFrame([(1, "b", AT, "h1"), (2, "b", AT - dt.timedelta(days=30), "h1"), (3, "b", None, "h3"), (4, "b", AT - dt.timedelta(days=200), "h4"), (5, "b", AT - dt.timedelta(days=200), "h3")], "id bigint, body string, published timestamp, cover_hash string")
    assert {r["id"]: r["body"] for r in L.compact(rows, F.lit(AT)).collect()} == {1: "b", 2: None, 3: "b", 4: None, 5: None}
    assert [r[0] for r in L.orphan_covers(rows, F.lit(AT)).collect()] == ["h4"]


def test_export_import_round_trip(spark, tmp_path):
    outlets = spark.createDataFrame([(1, "x.com", "X", "portal", 0.5), (2, "y.com", "Y é", "official", 1.0)], "id bigint, domain string, name string, type string, weight double")
    path = str(tmp_path / "out")
    files.export_jsonl({"outlet": outlets}, path)
    more = ["not json", json.dumps({"_t": "unknown", "a": 1}), "", json.dumps({"_t": "outlet", "id": 3, "domain": "z", "type": "spaceship"}), json.dumps({"_t": "outlet", "id": 9, "domain": "x.com", "name": "later", "type": "tv"})]
    (tmp_path / "out" / "zz.txt").write_text("\n".join(more))
    got, rejected = files.import_jsonl(spark, path, {"outlet": TABLES["outlet"]}, {"outlet": ["domain"]})
    rows = {r["domain"]: r["name"] for r in got["outlet"].collect()}
    assert rows.keys() == {"x.com", "y.com"} and rows["y.com"] == "Y é"
    assert rejected.count() == 3


SEARCH = """<rss><item><title>Port &amp; sea - Daily</title><link>https://n/rss/CB1?oc=5</link><pubDate>Tue, 05 Mar 2024 10:00:00 GMT</pubDate><source url="https://www.daily.com">Daily</source></item>
<item><title>No link</title></item><item><title>Bad date</title><link>https://n/rss/CB2</link><pubDate>soon</pubDate></item></rss>"""
ATOM = """<feed><entry><title><![CDATA[One]]></title><link rel="x" href="https://a.com/1"/><updated>2024-03-05T10:00:00Z</updated></entry><entry><title>Two</title><link href="https://a.com/2"/></entry></feed>"""


def test_feeds(spark):
    got = feeds.search_feed(spark.createDataFrame([(SEARCH, "q")], "xml string, expression string")).orderBy("gid").collect()
    assert [(r["title"], r["gid"], r["outlet_domain"], r["published"] is not None) for r in got] == [("Port & sea", "CB1", "daily.com", True), ("Bad date", "CB2", None, False)]
    got = feeds.native_feed(spark.createDataFrame([(ATOM, "https://www.a.com/feed")], "xml string, feed_url string")).orderBy("url").collect()
    assert [(r["title"], r["url"], r["published_precision"]) for r in got] == [("One", "https://a.com/1", "exact"), ("Two", "https://a.com/2", "unknown")]


def test_resolver_matches_by_index(spark):
    cell = lambda url, i: '["wrb.fr","X",' + json.dumps(json.dumps(["g", url])) + f',null,null,null,"{i}"]'
    text = ")]}'\n[" + ",".join([cell("https://x/second-story-about-boats", 2), cell("https://x/1", 1), '["wrb.fr","X","broken",null,null,null,"3"]']) + "]"
    got = feeds.resolver_reply(spark.createDataFrame([(1, text)], "batch int, reply string"))
    requests = spark.createDataFrame([(1, 1, "a", "First"), (1, 2, "b", "Unrelated title"), (1, 3, "c", "Third")], "batch int, index int, gid string, title string")
    rows = {r["gid"]: (r["url"], r["suspect_url"]) for r in feeds.attach_resolved(requests, got).collect()}
    assert rows == {"a": ("https://x/1", None), "b": (None, "https://x/second-story-about-boats"), "c": (None, None)}


def test_series_and_empty_reports(spark):
    schema = "id bigint, title string, outlet string, published timestamp, published_precision string, score int, cover_hash string"
    rows = spark.createDataFrame([(1, "t", "o", AT, "exact", 7, None), (2, "t", "o", AT + dt.timedelta(days=2), "exact", None, None)], schema)
    got = [(str(r["day"]), r["n"], r["mean_score"]) for r in report.daily_series(rows, F.lit("2024-03-04").cast("date")).orderBy("day").collect()]
    assert got == [("2024-03-01", 1, 7.0), ("2024-03-02", 0, None), ("2024-03-03", 1, None), ("2024-03-04", 0, None)]
    empty = spark.createDataFrame([], schema)
    assert report.kpis(empty).first()["mean_score"] is None
    assert report.daily_series(empty, F.lit("2024-03-30").cast("date")).count() == 30


def test_stream_equals_batch(spark, tmp_path):
    rows = [(1, "press", "https://x.com/1", "port opens new pier", AT), (2, "press", "https://www.x.com/1?utm_id=1", "port opens new pier", AT), (3, "press", "https://x.com/3", "port opens new pier", AT + dt.timedelta(hours=3)), (4, "press", "https://x.com/4", "else", None)]
    schema = "id bigint, channel string, url string, title string, published timestamp"
    for i, r in enumerate(rows):
        spark.createDataFrame([r], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = ingest.landed(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, 1)
    for _ in range(2):  # a second start finds nothing new
        ingest.store_batches(stream, str(tmp_path / "table"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "table"))
    stored = {r["id"]: r["story_id"] for r in got.collect()}
    assert len(stored) == 3 and 4 in stored and len({1, 2} & stored.keys()) == 1
    assert len(set(stored.values())) == 2
