"""Seeding, one collection, requests over a given connection, tasks and reports on hand-made rows."""

import datetime as dt
import gzip
import itertools
import json
import struct

import pytest
from pyspark.sql import functions as F

from newsloom.operators import collect as C
from newsloom.operators import lifecycle as L
from newsloom.plans import report
from newsloom.schemas import TABLES
from newsloom.sources import fetch, files

AT = dt.datetime(2024, 3, 1)
CONFIG = {
    "settings": {"client": '"x"'},
    "topics": [{"slug": "b", "name": "B", "position": 2, "queries": ["q1", "q2"]}, {"slug": "a", "name": "A", "position": 1, "sensitive": True, "queries": ["q2"]}],
    "sites": ["s.com"], "site_terms": ["t1", "t2"], "terms": [{"term": "w"}], "outlets": [{"domain": "o.com", "name": "O"}],
}


def test_seeding_again_changes_nothing_but_names(spark):
    once, counts = C.seed(spark, CONFIG, {}, F.lit(AT))
    assert {r["table"]: r["rows"] for r in counts.collect()} == {"topic": 2, "saved_query": 4, "tracked_term": 1, "outlet": 1}
    assert {name: df.columns for name, df in once.items()} == {name: spark.createDataFrame([], TABLES[name]).columns for name in once}
    off = {**once, "topic": once["topic"].withColumn("active", F.col("slug") == "a")}
    again, counts = C.seed(spark, {**CONFIG, "topics": [{"slug": "b", "name": "B2", "position": 5, "queries": []}]}, off, F.lit(AT))
    assert {r["slug"]: (r["name"], r["position"], r["active"]) for r in again["topic"].collect()} == {"a": ("A", 1, True), "b": ("B2", 5, False)}
    assert {r["table"]: r["rows"] for r in counts.collect()}["saved_query"] == 4
    assert [r["slug"] for r in report.active_topics(again["topic"]).collect()] == ["a"]
    asked = once["saved_query"].withColumn("active", F.col("expression") != "q1")
    assert [r["expression"] for r in C.queries_to_run(asked, "search").collect()] == ["q2"]
    assert C.queries_to_run(asked, limit=2).count() == 2


def test_one_collection(spark):
    search = [("search", 1, 0, "g1", "porto opens pier", "u1", AT, "a.com"), ("search", 2, 0, "g1", "porto opens pier again", "u1", AT, "a.com"), ("search", 2, 1, "g2", "nothing here", "u2", AT, None), ("search", 2, 2, "g3", "porto unresolved", "u3", AT, "b.com"), ("search", 2, 3, "g4", "porto suspect", "u4", AT, "www.B.com"), ("search", 2, 4, "g5", "porto opens pier today", "u5", AT, None)]
    search = spark.createDataFrame(search, "collector string, query_id bigint, place bigint, gid string, title string, feed_url string, published timestamp, outlet_domain string")
    native = spark.createDataFrame([("n1", "porto opens pier", "https://c.com/1?utm_id=2", AT, "https://c.com/rss"), ("n2", "noise", "https://c.com/2", AT, "https://c.com/rss"), ("n3", "porto stored", "https://c.com/old", AT, "https://d.com/rss")], "gid string, title string, url string, published timestamp, expression string")
    stored = spark.createDataFrame([("press", "https://c.com/old", 5, "porto opens big pier", AT, 77)], "channel string, u string, id bigint, title string, published timestamp, story_id bigint").withColumn("dedupe_hash", F.sha1(F.col("u").cast("binary")))
    outlets = spark.createDataFrame([(1, "a.com", "A", "tv", 1.0)], "id bigint, domain string, name string, type string, weight double")
    asked = []

    def resolve(items):
        asked.extend(r["gid"] for r in items.collect())
        url = F.when(F.col("gid") == "g1", "https://c.com/1").when(F.col("gid") == "g5", "https://e.com/5")
        return items.withColumns({"url": url, "suspect_url": F.when(F.col("gid") == "g4", "https://x/y")})

    out = C.collect(search, native, stored, outlets, ["porto"], [], F.lit(AT), resolve)
    items = {r["gid"]: r for r in out["items"].collect()}
    assert sorted(asked) == ["g1", "g3", "g4", "g5"]  # noise is not asked for
    assert {g: (r["outcome"], r["discard_reason"]) for g, r in items.items()} == {"g1": ("new", None), "g2": ("noise", L.NOISE), "g3": ("no-url", L.NO_URL), "g4": ("no-url", L.SUSPECT_URL), "g5": ("new", None), "n2": ("noise", L.NOISE), "n3": ("repeated", None)}
    assert items["g1"]["title"] == "porto opens pier" and items["g1"]["story_id"] == items["g5"]["story_id"] == 77
    assert {r["domain"]: (r["type"], r["weight"]) for r in out["outlets"].collect()} == {"a.com": ("tv", 1.0), "unknown": ("portal", 0.5), "b.com": ("portal", 0.5), "e.com": ("portal", 0.5)}
    assert {r["mention_id"] for r in out["tasks"].collect()} == {items["g1"]["id"], items["g5"]["id"]}
    assert sorted((r["collector"], r["query_id"] or 0, r["found"], r["new"], r["status"]) for r in out["runs"].collect()) == [("native", 0, 1, 0, "ok"), ("native", 0, 2, 0, "ok"), ("search", 1, 1, None, "ok"), ("search", 2, 5, None, "ok")]
    nothing = C.run_rows(search.limit(0), native.limit(0), out["items"], F.lit(AT), spark.createDataFrame([("search", 9)], "collector string, id bigint"))
    assert [(r["query_id"], r["found"], r["status"]) for r in nothing.collect()] == [(9, 0, "failed")]


def test_new_items_of_one_run_share_a_story(spark):
    search = spark.createDataFrame([("search", 1, i, f"g{i}", f"porto opens new pier {i}", "u", AT, "a.com", f"https://a.com/{i}") for i in range(3)], "collector string, query_id bigint, place bigint, gid string, title string, feed_url string, published timestamp, outlet_domain string, url string")
    native = spark.createDataFrame([], "gid string, title string, url string, published timestamp, expression string")
    stored = spark.createDataFrame([], "channel string, dedupe_hash string, id bigint, title string, published timestamp, story_id bigint")
    out = C.collect(search, native, stored, spark.createDataFrame([], TABLES["outlet"]), ["porto"], [], F.lit(AT))
    assert len({r["story_id"] for r in out["items"].collect()}) == 1


def test_bodies():
    long = [b"x" * 100] * 50
    assert len(fetch.whole_body(long, False, 1e12, most=950)) == 1000
    packed = gzip.compress(b"text " * 5000)
    assert fetch.whole_body([packed], True, 1e12) == b"text " * 5000
    assert b"text " * 5000 != fetch.whole_body([packed[:60]], True, 1e12) and b"text ".startswith(fetch.whole_body([packed[:60]], True, 1e12)[:5])
    assert fetch.whole_body([b"no gzip"], True, 1e12) == b""
    clock = itertools.count().__next__
    assert fetch.whole_body(long, False, 3, clock=clock) is None


def test_fetch_errors_are_rows_and_hosts_take_turns(spark):
    def opener(url):
        import time

        if "bad" in url:
            raise OSError
        if "slow" in url:
            return 200, {}, (time.sleep(0.3) or b"x" for _ in range(9))
        return (200, {"Content-Encoding": "gzip"}, [gzip.compress(str(time.monotonic()).encode())]) if "good" in url else (404, {}, [b"gone"])

    urls = ["https://good/1", "https://good/2", "https://good/3", "https://bad/", "https://x/", "https://slow/", None]
    rows = fetch.fetched(spark.createDataFrame(list(enumerate(urls)), "id bigint, url string"), opener, spacing=0.4, special={"slow": 0.0}, deadline=1.0).collect()
    got = {r["id"]: (r["status"], bytes(r["content"])) for r in rows}
    assert {k: v for k, v in got.items() if k > 2} == {3: (0, b""), 4: (404, b""), 5: (0, b""), 6: (0, b"")}
    times = sorted(float(got[i][1]) for i in range(3))
    assert times[1] - times[0] >= 0.39 and times[2] - times[1] >= 0.39


def test_batches_hold_each_request_once(spark):
    rows = spark.createDataFrame([(f"g{i}", 1, "A" * 22) for i in range(200)], "gid string, at bigint, signature string")
    placed = fetch.in_batches(rows, 15, 4).collect()
    by = {}
    for r in placed:
        by.setdefault(r["batch"], []).append(r["index"])
    assert len(placed) == 200 and all(sorted(v) == list(range(1, len(v) + 1)) and len(v) <= 15 for v in by.values())
    from urllib.parse import parse_qs

    one = spark.createDataFrame([('q"\\', 7, "A" * 22)], "gid string, at bigint, signature string")
    body = fetch.batch_request(fetch.in_batches(one)).first()["body"]
    ((name, asked, none, index),) = json.loads(parse_qs(body)["f.req"][0])[0]
    assert (name, none, index) == ("Fbv4je", None, "1") and json.loads(asked)[2:] == ['q"\\', 7, "A" * 22]


@pytest.mark.parametrize("page, want", [('x,1700000000,&quot;Abcdefghijklmnopqrstuv&quot;', (1700000000, "Abcdefghijklmnopqrstuv")), ("none", None), (None, None)])
def test_signature(spark, page, want):
    got = spark.createDataFrame([(page,)], "p string").select(fetch.signature("p").alias("s")).first()["s"]
    assert (tuple(got) if got else None) == want


def test_the_same_score_again_is_another_row(spark):
    items = spark.createDataFrame([(1, "t", "s", "b")], "id bigint, title string, summary string, body string")
    scores = spark.createDataFrame([(1, 7, "r", ["t"], "high")], "mention_id bigint, score int, reason string, evidence array<string>, confidence string")
    ids = {L.assess(items, scores, rubric, F.lit(at), origin).first()["id"] for rubric in (1, 2) for at in (AT, AT + dt.timedelta(days=1)) for origin in ("human", "auto")}
    assert len(ids) == 8 and L.assess(items, scores, 1, F.lit(AT)).first()["id"] in ids


def test_a_page_without_summary_is_tagged_by_the_title_alone(spark):
    items = spark.createDataFrame([(1, "t", "porto porto", "b", None, None, AT, "exact", "raw", None), (2, "t", "porto mar", "b", None, None, AT, "exact", "raw", None)], "id bigint, title string, summary string, body string, author string, cover_url string, published timestamp, published_precision string, state string, discard_reason string")
    pages = spark.createDataFrame([(1, None, None, None, None, None, None), (2, "http 403", None, None, None, None, None)], "id bigint, error string, summary string, author string, cover string, published timestamp, body string")
    got = {r["id"]: (r["state"], r["summary"]) for r in L.enrich(items, pages, {"x": ["porto", "mar"]}).collect()}
    assert got == {1: ("discarded", "porto porto"), 2: ("enriched", "porto mar")}


def test_prompt_leaves_marks_in_values_alone(spark):
    items = spark.createDataFrame([(1, "{text}", None, None, "b" * 9)], "id bigint, title string, summary string, outlet string, body string")
    assert L.prompt(items, "{title}|{outlet}|{rubric}|{client}|{text}{", "{client}", "C", 4).first()["prompt"] == "{text}|unknown|{client}|C|\n\nbbbb{"


def test_edition_tree(spark):
    rows = spark.createDataFrame([(i, i % 11 if i % 3 else None) for i in range(2500)] + [(10**17, 5)], "id bigint, score int")
    one = report.edition(rows).first()
    assert one["n"] == 2501 and one == report.edition(rows.repartition(7)).first()
    assert one["hash"] != report.edition(rows.withColumn("score", F.when(F.col("id") == 9, 1).otherwise(F.col("score")))).first()["hash"]
    assert report.edition(rows.limit(0)).first()["n"] == 0


def test_config_values(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"limits": {"a": 1}, "list": [1, 2]}')
    config = files.read_config(spark, str(tmp_path / "c.json"))
    assert files.config_value(config, "limits", "a int")["a"] == 1 and files.config_value(config, "list", "array<int>") == [1, 2] and files.config_value(config, "none", "a int") is None


def test_publish_writes_a_small_head_and_all_items(spark, tmp_path):
    rows = [(i, f"t{i}", "o", AT + dt.timedelta(hours=i), "exact", i % 11, 1, ["x"]) for i in range(50)]
    items = spark.createDataFrame(rows, "id bigint, title string, outlet string, published timestamp, published_precision string, score int, replicas bigint, topics array<string>")
    report.publish(items, spark.createDataFrame([("o", "portal")], "domain string, type string"), F.lit("2024-03-05").cast("date"), str(tmp_path))
    head = json.loads(spark.read.text(str(tmp_path / "head")).first()["value"])
    assert head["kpi"]["mentions"] == 50 and "items" not in head
    assert spark.read.json(str(tmp_path / "items")).count() == 50


def test_image_sizes(spark, tmp_path):
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", 640, 360)
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xff\xdb\x00\x03x\xff\xc2\x00\x11\x08" + struct.pack(">HH", 181, 321) + b"rest of it"
    riff = lambda kind, body: b"RIFF\0\0\0\0WEBP" + kind + b"\0\0\0\0" + body + b"\0" * 12
    lossy, lossless, wide = riff(b"VP8 ", b"\0\0\0\x9d\x01\x2a" + struct.pack("<HH", 400, 300)), riff(b"VP8L", b"\x2f" + struct.pack("<I", 499 | 399 << 14)), riff(b"VP8X", b"\0" * 4 + b"\xff\x03\0\x37\x02\0")
    want = {png: (640, 360), jpeg: (321, 181), lossy: (400, 300), lossless: (500, 400), wide: (1024, 568), b"": None, b"\xff\xd8\xff": None, jpeg[:20]: None, b"text": None}
    assert {data: files.image_size(data) for data in want} == want
    for i, data in enumerate([png, jpeg, wide, b"\xff\xd8\xff\xe0", png.replace(struct.pack(">I", 360), struct.pack(">I", 100))]):
        (tmp_path / f"{i}.img").write_bytes(data)
    got = {r["path"].rpartition("/")[2]: (r["format"], r["width"], r["height"], r["status"]) for r in files.covers(spark, str(tmp_path)).collect()}
    assert got == {"0.img": ("png", 640, 360, "ok"), "1.img": ("jpeg", 321, 181, "ok"), "2.img": ("webp", 1024, 568, "ok"), "3.img": ("jpeg", None, None, "failed"), "4.img": ("png", 640, 100, "failed")}
