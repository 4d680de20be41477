"""Registered queries of collection, seeding, files, tasks and the published document, with their SQL."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from newsloom.functions import dates, html, text
from newsloom.operators import collect as C
from newsloom.operators import dedupe, lifecycle, stories
from newsloom.operators.tables import Scratch, scratch_root
from newsloom.plans import adapters as A
from newsloom.plans import report
from newsloom.plans.catalog import AS_OF, CANON, CLOSURE, ENRICH, TOPIC, _enriched, _relevance_sql, _t, query
from newsloom.schemas import TABLES
from newsloom.sources import feeds, files


def _at():
    return F.lit(AS_OF).cast("timestamp")


# collection

RELEVANCE = _relevance_sql().replace("strip_accents(lower(title || ' ' || summary))", "strip_accents(lower(title || ' '))")
COLLECT = f"""{CANON}, {RELEVANCE},
found AS (SELECT 'g' || (page_id // 2) AS gid, page_id, page_id % 7 AS q, title, CASE WHEN page_id % 9 > 0 THEN canonical_url END AS u, CASE WHEN page_id % 4 > 0 THEN outlet END AS outlet FROM canon JOIN mention ON id = page_id),
once AS (SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY gid ORDER BY q, page_id) = 1),
both_ AS (SELECT 0 AS o, gid, page_id, u, outlet FROM once UNION ALL SELECT 1, canonical_url, page_id, canonical_url, outlet FROM canon JOIN mention ON id = page_id WHERE page_id % 5 = 0),
told AS (SELECT b.*, CASE WHEN relevance < 0.35 THEN 'noise' WHEN u IS NULL THEN 'no-url' END AS gone FROM both_ b JOIN rel ON rel.id = page_id),
first_ AS (SELECT * FROM told QUALIFY row_number() OVER (PARTITION BY CASE WHEN gone IS NULL THEN u ELSE 'search:' || gid END ORDER BY o, gid) = 1),
known AS (SELECT canonical_url AS u FROM canon WHERE page_id % 6 = 0),
out_ AS (SELECT f.*, CASE WHEN gone IS NULL AND f.u IN (SELECT u FROM known) THEN 'repeated' ELSE coalesce(gone, 'new') END AS outcome FROM first_ f)"""


def _collected(spark, d):
    """Search items of seven queries with gids twice, native items of every fifth page, a store that has every sixth."""
    m = A.mentions(spark, d).select(F.col("id").alias("page_id"), "title", "outlet", "published")
    p = _t(spark, d, "pages").select("page_id", "url").join(m, "page_id")
    search = p.select(F.lit("search").alias("collector"), (F.col("page_id") % 7).alias("query_id"), F.col("page_id").alias("place"), F.concat(F.lit("g"), F.expr("page_id div 2")).alias("gid"), "title", "url", "published", F.when(F.col("page_id") % 4 > 0, F.col("outlet")).alias("outlet_domain"), F.lit("q").alias("expression"))
    native = p.where("page_id % 5 = 0").select(F.col("page_id").alias("place"), "title", text.canonical_url("url").alias("gid"), F.concat("url", F.when(F.col("url").contains("?"), "&fbclid=1").otherwise("?fbclid=1")).alias("url"), "published", F.col("outlet").alias("outlet_domain"), F.concat(F.lit("https://f"), F.col("page_id") % 3, F.lit("/rss")).alias("expression"))
    native = native.withColumn("url", F.regexp_replace("url", "^([^#]*)#([^?&]*)([?&].*)$", "$1$3#$2"))
    stored = dedupe.with_dedupe_hash(p.where("page_id % 6 = 0")).select(F.lit("press").alias("channel"), "dedupe_hash", (F.col("page_id") + 10**9).alias("id"), "title", "published", (F.col("page_id") + 10**9).alias("story_id"))
    resolve = lambda items: items.withColumn("url", F.when(F.col("place") % 9 > 0, F.col("url")))
    outlets = A.outlets(spark, d).where("domain < 'src3'").select(F.monotonically_increasing_id().alias("id"), "domain", F.col("domain").alias("name"), "type", F.lit(1.0).alias("weight"))
    out = C.collect(search, native, stored, outlets, A.REQUIRED, A.PENALISED, _at(), resolve)
    out["items"] = Scratch(spark, "collected").write(out["items"], "items")
    return search, native, out


@query(f"& {COLLECT} SELECT o AS channel_order, outcome, count(*) AS n FROM out_ GROUP BY 1, 2")
def collect(spark, d):
    return _collected(spark, d)[2]["items"].groupBy(F.col("_order").alias("channel_order"), "outcome").agg(F.count("*").alias("n"))


@query(f"& {COLLECT} SELECT state, reason, count(*) AS n FROM (SELECT CASE WHEN gone IS NULL THEN 'raw' ELSE 'discarded' END AS state, CASE gone WHEN 'noise' THEN 'relevance below cut' WHEN 'no-url' THEN 'url not resolved' END AS reason FROM out_) GROUP BY 1, 2")
def collect_states(spark, d):
    return _collected(spark, d)[2]["items"].groupBy("state", F.col("discard_reason").alias("reason")).agg(F.count("*").alias("n"))


@query(f"""& {COLLECT}, need AS (SELECT coalesce(outlet, CASE WHEN gone IS NULL THEN regexp_extract(u, 'https://([^/?#]*)', 1) END, 'unknown') AS domain FROM out_ WHERE outcome <> 'repeated')
SELECT domain, max(weight) AS weight FROM (SELECT domain, 1.0::DOUBLE AS weight FROM outlet WHERE domain < 'src3' UNION ALL SELECT DISTINCT domain, 0.5::DOUBLE FROM need) GROUP BY 1""")
def collect_outlets(spark, d):
    """Outlets known before, and new domains as shallow rows: discards count too."""
    _, _, out = _collected(spark, d)
    return out["outlets"].select("domain", "weight")


@query(f"& {COLLECT} SELECT 'enrich' AS task, 3 AS priority, count(*) AS n FROM out_ WHERE outcome = 'new'")
def collect_tasks(spark, d):
    return _collected(spark, d)[2]["tasks"].groupBy("task", "priority").agg(F.count("*").alias("n"))


@query(f"""& {COLLECT} SELECT 'search' AS collector, q::BIGINT AS query_id, NULL AS feed, count(*)::INTEGER AS found, NULL::INTEGER AS new, 'ok' AS status FROM found GROUP BY 2
UNION ALL SELECT 'native', NULL, 'https://f' || (page_id % 3) || '/rss', count(*)::INTEGER, (count(*) FILTER (page_id IN (SELECT page_id FROM out_ WHERE o = 1 AND outcome = 'new')))::INTEGER, 'ok' FROM canon JOIN mention ON id = page_id WHERE page_id % 5 = 0 GROUP BY 3""")
def collect_runs(spark, d):
    return _collected(spark, d)[2]["runs"].select("collector", "query_id", F.get_json_object("params", "$.feed").alias("feed"), "found", "new", "status")


@query("""& a AS (SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id) = 1) SELECT user_id AS gid, event_type AS collector, event_id AS place FROM a""")
def first_over_queries(spark, d):
    e = _t(spark, d, "events").select(F.col("user_id").alias("gid"), F.col("event_type").alias("collector"), F.lit(1).alias("query_id"), F.col("event_id").alias("place"))
    return C.first_per_gid(e).select("gid", "collector", "place")


def _saved_queries(spark, d):
    r, n = _t(spark, d, "region"), _t(spark, d, "nation")
    return r.crossJoin(F.broadcast(n)).select((F.col("r_regionkey") * 100 + F.col("n_nationkey")).cast("bigint").alias("id"), F.when(F.col("n_nationkey") % 2 == 0, "search").otherwise("sites").alias("collector"), F.concat_ws(" ", "r_name", "n_name").alias("expression"), ((F.col("n_nationkey") + F.col("r_regionkey")) % 3 != 0).alias("active"))


@query("""SELECT (r_regionkey * 100 + n_nationkey)::BIGINT AS id, r_name || ' ' || n_name AS expression FROM region, nation WHERE n_nationkey % 2 = 0 AND (n_nationkey + r_regionkey) % 3 <> 0 ORDER BY id LIMIT 20""")
def queries_to_run(spark, d):
    """A run's first twenty active queries of one collector: the limit is the run's own."""
    return C.queries_to_run(_saved_queries(spark, d), "search", 20).select("id", "expression")


def _config(spark, d) -> dict:
    regions = [r["r_name"] for r in _t(spark, d, "region").select("r_name").collect()]  # the configuration's few lines
    nations = [r["n_name"] for r in _t(spark, d, "nation").select("n_name").collect()]
    return {
        "settings": {"client": json.dumps("someone")},
        "topics": [{"slug": r.lower(), "name": r, "position": k, "queries": [r, f"{r} news", regions[0]]} for k, r in enumerate(regions)],
        "sites": [f"{r.lower()}.com" for r in regions], "site_terms": nations,
        "terms": [{"term": n, "type": "brand"} for n in nations], "outlets": [{"domain": f"{n.lower()}.org", "name": n} for n in nations],
    }


@query("""& q AS (SELECT DISTINCT 'search' AS c, unnest([r_name, r_name || ' news', (SELECT first(r_name) FROM region)]) AS e FROM region)
SELECT 'topic' AS "table", count(*) AS rows FROM region UNION ALL SELECT 'tracked_term', count(*) FROM nation UNION ALL SELECT 'outlet', count(*) FROM nation UNION ALL SELECT 'saved_query', (SELECT count(*) FROM q) + (SELECT count(*) FROM region, nation)""")
def seed_counts(spark, d):
    """Rows after seeding twice: the second time adds nothing."""
    once, _ = C.seed(spark, _config(spark, d), {}, _at())
    return C.seed(spark, _config(spark, d), once, _at())[1]


@query("""SELECT 'nation' AS "table", count(*) AS rows FROM nation UNION ALL SELECT 'region', count(*) FROM region UNION ALL SELECT 'events', count(*) FROM events""")
def export_counts(spark, d):
    return files.export_counts({t: _t(spark, d, t) for t in ("nation", "region", "events")})


@query("""SELECT s_suppkey AS id, 'd' || s_suppkey || '.com' AS domain, CASE WHEN s_suppkey % 4 = 0 THEN 'later' ELSE s_name END AS name FROM supplier WHERE s_suppkey % 5 <> 0
UNION ALL SELECT -1, 'rejected', count(*)::VARCHAR FROM supplier WHERE s_suppkey % 5 = 0 OR s_suppkey % 7 = 0""")
def export_import(spark, d):
    """A round trip through JSON lines: every fifth row breaks a rule, every fourth comes again, every seventh line is of an unknown table."""
    s = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.concat(F.lit("d"), "s_suppkey", F.lit(".com")).alias("domain"), F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 5 == 0, "spaceship").otherwise("portal").alias("type"))
    path = f"{scratch_root(spark)}/export-{uuid.uuid4().hex[:8]}"
    # one file each, read in their names' order: the last line of a key stays
    files.export_jsonl({"outlet": s.coalesce(1), "nowhere": s.where("id % 7 = 0 AND id % 5 <> 0").coalesce(1)}, path)
    again = s.where("id % 4 = 0 AND id % 5 <> 0").withColumn("name", F.lit("later"))
    again.select(F.to_json(F.struct(F.lit("outlet").alias("_t"), "*")).alias("value")).coalesce(1).write.mode("append").text(path)
    got, rejected = files.import_jsonl(spark, path, {"outlet": TABLES["outlet"]}, {"outlet": ["domain"]}, later=F.col("r.name") == "later")
    return got["outlet"].select("id", "domain", "name").unionByName(rejected.agg(F.lit(-1).cast("bigint").alias("id"), F.lit("rejected").alias("domain"), F.count("*").cast("string").alias("name")))


# feeds and addresses

@query("""SELECT 'Story ' || page_id || ' & more' AS title, 'CB' || page_id AS gid, CASE WHEN page_id % 4 > 0 THEN 'o' || (page_id % 7) || '.com' END AS outlet_domain, CASE WHEN page_id % 5 > 0 THEN TIMESTAMP '2024-03-05 10:00:00' END AS published FROM pages WHERE page_id % 11 > 0""")
def search_feed(spark, d):
    """A feed of each page: entities, the outlet's name at the title's end, missing sources, bad dates, items without a link."""
    i = F.col("page_id").cast("string")
    name = F.concat(F.lit("Outlet "), F.col("page_id") % 7)
    source = F.when(F.col("page_id") % 4 > 0, F.concat(F.lit('<source url="https://www.o'), F.col("page_id") % 7, F.lit('.com">'), name, F.lit("</source>"))).otherwise("")
    end = F.when(F.col("page_id") % 4 > 0, F.concat(F.lit(" - "), name)).otherwise("")
    link = F.when(F.col("page_id") % 11 > 0, F.concat(F.lit("<link>https://n/rss/CB"), i, F.lit("?oc=5</link>"))).otherwise("")
    at = F.when(F.col("page_id") % 5 > 0, "Tue, 05 Mar 2024 10:00:00 GMT").otherwise("soon")
    xml = F.concat(F.lit("<rss><channel><title>feed</title><item><title>Story "), i, F.lit(" &amp; more"), end, F.lit("</title>"), link, F.lit("<pubDate>"), at, F.lit("</pubDate>"), source, F.lit("</item><item><title>open"))
    got = feeds.search_feed(_t(spark, d, "pages").select(xml.alias("xml"), F.lit("q").alias("expression")))
    return got.select("title", "gid", "outlet_domain", F.to_timestamp_ntz(F.col("published").cast("string")).alias("published"))


@query("""SELECT 'T ' || page_id AS title, 'https://a.com/' || page_id AS url, CASE WHEN page_id % 3 = 2 THEN 'unknown' ELSE 'exact' END AS precision FROM pages""")
def native_feed(spark, d):
    """Feeds of RSS with CDATA and of Atom with links as attributes and other date tags."""
    i = F.col("page_id").cast("string")
    rss = F.concat(F.lit("<rss><item><title><![CDATA[T "), i, F.lit("]]></title><link><![CDATA[https://a.com/"), i, F.lit("]]></link><pubDate>Tue, 05 Mar 2024 10:00:00 -0300</pubDate></item></rss>"))
    atom = F.concat(F.lit('<feed><entry><title type="html">T '), i, F.lit('</title><link rel="edit" href="/x"/><link rel="alternate" href="https://a.com/'), i, F.lit('"/>'), F.when(F.col("page_id") % 3 == 1, "<updated>2024-03-05T10:00:00Z</updated>").otherwise(""), F.lit("</entry></feed>"))
    got = feeds.native_feed(_t(spark, d, "pages").select(F.when(F.col("page_id") % 3 == 0, rss).otherwise(atom).alias("xml"), F.lit("https://www.a.com/feed").alias("feed_url")))
    return got.select("title", "url", F.col("published_precision").alias("precision"))


@query("""SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 > 0 THEN 'https://x.com/supplier-' || s_suppkey END AS url, CASE WHEN s_suppkey % 3 = 0 AND s_suppkey % 2 = 0 THEN 'https://x.com/second-story-about-boats' END AS suspect FROM supplier""")
def resolve_addresses(spark, d):
    """Requests in batches of fifteen; replies out of order, with broken envelopes and addresses that do not fit."""
    s = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_suppkey").cast("string").alias("gid"), F.concat(F.lit("Supplier "), "s_suppkey").alias("title"))
    signed = s.select("gid", F.lit(1700000000).cast("bigint").alias("at"), F.lit("A" * 24).alias("signature"))
    from newsloom.sources.fetch import resolve

    def send(body: str) -> str:
        from urllib.parse import parse_qs

        cells = []
        for _, asked, _, index in json.loads(parse_qs(body)["f.req"][0])[0]:
            i = int(json.loads(asked)[2])
            url = f"https://x.com/supplier-{i}" if i % 3 else "https://x.com/second-story-about-boats"
            said = json.dumps(["r", url, 1]) if i % 3 or i % 2 == 0 else "broken"
            cells.append(f'["wrb.fr","Fbv4je",{json.dumps(said)},null,null,null,"{index}"]')
        return ")]}'\n\n[" + ",".join(reversed(cells)) + "]"

    return resolve(s, signed, send).select("id", "url", F.col("suspect_url").alias("suspect"))


@query("""SELECT page_id, CASE WHEN page_id % 3 > 0 THEN 1700000000 + page_id END AS at, CASE WHEN page_id % 3 > 0 THEN 'Abcdefghijklmnopqrstuv-' || page_id END AS signature FROM pages""")
def signatures(spark, d):
    from newsloom.sources.fetch import signature

    i = F.col("page_id")
    page = F.concat("html", F.when(i % 3 > 0, F.concat(F.lit("<c data-p=\",&quot;x&quot;,"), i + 1700000000, F.lit(",&quot;Abcdefghijklmnopqrstuv-"), i, F.lit("&quot;]\">"))).otherwise(",123,&quot;A&quot;"))
    return _t(spark, d, "pages").select("page_id", signature(page).alias("s")).select("page_id", "s.at", "s.signature")


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://y/z' WHEN 1 THEN 'https://y/z' WHEN 2 THEN 'https://x.com/z' ELSE 'https://x.com/a/z.png' END AS cover, h[1:2] || '/' || h[3:4] || '/' || h || '.webp' AS path, CASE WHEN page_id % 2 = 0 THEN 'News' ELSE 'News - B' END AS title FROM (SELECT *, sha1(url) AS h FROM pages)""")
def addresses_and_paths(spark, d):
    i = F.col("page_id")
    link = F.when(i % 4 == 0, "https://y/z").when(i % 4 == 1, "//y/z").when(i % 4 == 2, "/z").otherwise("z.png")
    title = text.without_suffix(F.when(i % 2 == 0, "News - A").otherwise("News - B"), F.lit("A"))
    return _t(spark, d, "pages").select("page_id", html.absolute(F.lit("https://x.com/a/b"), link).alias("cover"), files.cover_path(F.sha1(F.col("url").cast("binary")), F.lit("webp")).alias("path"), title.alias("title"))


@query("""SELECT event_id, ts >= TIMESTAMP '2024-01-20' - INTERVAL 7 DAY AS recent, round(abs(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-20')) / 3600000000.0, 6) AS hours FROM events""")
def date_windows(spark, d):
    e = _t(spark, d, "events")
    at = F.lit("2024-01-20").cast("timestamp")
    ts = F.col("ts").cast("string").cast("timestamp")
    return e.select("event_id", dates.within_days(ts, at, 7).alias("recent"), F.round(dates.hours_apart(ts, at), 6).alias("hours"))


# covers, tasks, logs

@query("""SELECT DISTINCT cover_hash FROM wall WHERE cover_hash IS NOT NULL AND cover_hash NOT IN (SELECT sha1(i::VARCHAR) FROM range(0, 40, 3) t(i))""")
def covers_to_copy(spark, d):
    present = spark.range(0, 40, 3).select(F.sha1(F.col("id").cast("string").cast("binary")).alias("cover_hash"))
    return files.covers_to_copy(A.wall(spark, d), present)


@query("""SELECT id, CASE WHEN id % 3 = 0 THEN 'h' || id ELSE cover_hash END AS cover_hash, CASE id % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'failed' ELSE 'pending' END AS cover_status FROM mention""")
def cover_results(spark, d):
    m = A.mentions(spark, d).withColumn("cover_status", F.lit("pending"))
    got = m.where("id % 3 < 2").select("id", F.when(F.col("id") % 3 == 0, F.concat(F.lit("h"), "id")).alias("hash"), F.when(F.col("id") % 3 == 1, "timeout").alias("error"))
    return lifecycle.update_covers(m, got).select("id", "cover_hash", "cover_status")


@query("""SELECT id FROM mention WHERE state = 'raw' ORDER BY published DESC, id LIMIT 100""")
def enrich_queue(spark, d):
    """A run's hundred newest raw mentions: the limit is the run's own."""
    return lifecycle.work_list(A.mentions(spark, d), "enrich", 100).select("id")


@query(f"& {ENRICH} SELECT 'warning' AS level, 'item ' || id || ' blocked: http 403 - https://x/' || id AS message FROM enriched WHERE page = 'blocked'")
def blocked_warnings(spark, d):
    m, pages, _ = _enriched(spark, d)
    return lifecycle.blocked_warnings(m.withColumn("url", F.concat(F.lit("https://x/"), "id")), pages, _at()).select("level", "message")


@query(f"& {ENRICH} SELECT id AS mention_id, 'cover' AS task, 4 AS priority FROM enriched WHERE cover_url IS NOT NULL AND state = 'enriched'")
def cover_tasks(spark, d):
    _, pages, enriched = _enriched(spark, d)
    return lifecycle.cover_tasks(enriched, pages).select("mention_id", "task", "priority")


@query("""& q AS (SELECT event_id AS id, (event_id % 5)::INTEGER AS priority, CASE WHEN event_id % 3 = 0 THEN (event_id % 4 + 1)::INTEGER ELSE (event_id % 4)::INTEGER END AS attempts, CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-20' + to_minutes((5 * 2 ** (event_id % 4))::INTEGER) ELSE ts END AS next_at FROM events)
SELECT id, priority, attempts FROM q WHERE next_at <= TIMESTAMP '2024-01-20 00:25:00' AND attempts < 4""")
def queue_after_failures(spark, d):
    """Every third task fails and waits; then those due a little later, less those tried too often."""
    at = F.lit("2024-01-20").cast("timestamp")
    e = _t(spark, d, "events").select(F.col("event_id").alias("id"), (F.col("event_id") % 5).cast("int").alias("priority"), (F.col("event_id") % 4).cast("int").alias("attempts"), F.col("ts").cast("string").cast("timestamp").alias("next_at"), F.lit(None).cast("string").alias("error"))
    later = lifecycle.put_off(e, e.where("id % 3 = 0").select("id", F.lit("timeout").alias("error")), at)
    return lifecycle.due_tasks(later, at + F.expr("INTERVAL 25 MINUTES"), 4).select("id", "priority", "attempts")


@query("""SELECT 'v1.' || n AS version, CASE n WHEN 0 THEN sha256('tpm{}') WHEN 1 THEN sha256('t2pm{}') ELSE sha256('t2pm2{}') END AS hash FROM range(3) r(n)""")
def rubric_versions(spark, d):
    """Five seeds of which three have something new."""
    rubrics = spark.createDataFrame([], "hash string, text string, prompt string, model string, bands string, valid_from date, version string")
    for words, model in (("t", "m"), ("t", "m"), ("t2", "m"), ("t2", "m2"), ("t", "m")):
        rubrics = lifecycle.rubric_versions(rubrics, words, "p", model, "{}", _at())
    return rubrics.select("version", "hash")


@query("""SELECT n_name AS version, n_name AS title, n_nationkey::VARCHAR AS model FROM nation ORDER BY n_nationkey DESC LIMIT 1""")
def latest_rubric(spark, d):
    n = _t(spark, d, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("version"), F.col("n_name").alias("title"), F.col("n_nationkey").cast("string").alias("model"))
    return report.latest_rubric(n)


@query("""& s AS (SELECT id, (length(title) % 14)::INTEGER AS score, length(title) AS i, length(body) % 900 AS o, id % 11 = 3 AS failed FROM wall LEFT JOIN assessment ON item_id = id WHERE score IS NULL AND state = 'enriched')
SELECT count(*) FILTER (NOT failed) AS ok, count(*) FILTER (failed) AS failed, round(sum(CASE WHEN NOT failed THEN round_even(i / 1e6 * 1.0 + o / 1e6 * 5.0, 6) END), 6) AS cost FROM s""")
def auto_assess(spark, d):
    """A deterministic scorer over everything that waits; its counters."""

    def scorer(frames):
        for f in frames:
            f = f.assign(mention_id=f["id"], score=f["title"].str.len() % 14, reason="r", evidence=[[t[:20]] for t in f["title"]], confidence="high", tokens_in=f["title"].str.len(), tokens_out=f["body"].str.len() % 900, error=None)
            f.loc[f["id"] % 11 == 3, "error"] = "timeout"
            yield f[["mention_id", "score", "reason", "evidence", "confidence", "tokens_in", "tokens_out", "error"]]

    w = A.scored_wall(spark, d).withColumn("assessment_id", F.col("score")).drop("score")
    counters = lifecycle.auto_assess(w, scorer, 1, _at(), limit=None)[1]
    return counters.select("ok", "failed", F.round("cost", 6).alias("cost"))


@query("""SELECT id, 'For ACME by {title} of ' || outlet || ': ' || title || chr(10) || summary || chr(10) || chr(10) || left(body, 6000) AS prompt FROM wall""")
def prompts(spark, d):
    """The scorer's texts: a rubric that holds a mark stays as it is; the body's limit is a call's budget."""
    return lifecycle.prompt(A.wall(spark, d), "For {client} by {rubric} of {outlet}: {title}\n{text}", "{title}", "ACME")


# reports

@query(f"& {CLOSURE}, n AS (SELECT story_id, count(*) AS n_mentions, arg_min(title, id) AS canonical_title FROM story JOIN wall USING (id) GROUP BY 1) SELECT story_id, canonical_title, n_mentions FROM n WHERE n_mentions > 1 ORDER BY n_mentions DESC, story_id LIMIT 5")
def top_stories(spark, d):
    w = A.wall(spark, d)
    return report.top_stories(stories.rollup(w, stories.stories(w)))


@query(f"& {CLOSURE} SELECT count(*) AS mentions, count(cover_hash) AS with_cover, count(*) FILTER (published_precision = 'exact') AS exact_date, count(score) AS scored, (SELECT count(*) FROM mention) AS scanned, (SELECT count(DISTINCT story_id) FROM story) AS stories FROM wall LEFT JOIN assessment ON item_id = id")
def state_report(spark, d):
    m, a, w = A.mentions(spark, d), A.assessments(spark, d), A.wall(spark, d)
    scored = m.join(a, m.id == a.item_id, "left").drop("item_id")
    return report.state_report(scored, A.outlets(spark, d), stories.rollup(w, stories.stories(w)))["counts"]


@query("""SELECT count(*) FILTER (item_id % 3 > 0) AS human, count(*) AS assessments FROM assessment""")
def human_scores(spark, d):
    return report.origin_counts(A.assessments(spark, d).withColumn("origin", F.when(F.col("item_id") % 3 > 0, "human").otherwise("auto")))


@query("""& r AS (SELECT user_id, event_type, count(*) FILTER (value > 50) AS found FROM events GROUP BY 1, 2) SELECT count(*) FILTER (found = 0 OR user_id % 17 = 0) AS failed_runs FROM r""")
def failed_runs(spark, d):
    """Runs that found nothing, and those cut short."""
    runs = _t(spark, d, "events").groupBy("user_id", "event_type").agg(F.count_if(F.col("value") > 50).alias("found"))
    return report.failed_runs(runs.withColumn("status", F.when(F.col("found") == 0, "failed").when(F.col("user_id") % 17 == 0, "partial").otherwise("ok")))


@query(f"""& {CLOSURE}, size AS (SELECT story_id, count(*) AS replicas FROM story GROUP BY 1)
SELECT wall.id, replicas, score, CASE WHEN cover_hash IN (SELECT sha1(i::VARCHAR) FROM range(0, 40, 4) t(i)) THEN 'p' || left(cover_hash, 4) END AS preview FROM wall JOIN story ON story.id = wall.id JOIN size USING (story_id) LEFT JOIN assessment ON item_id = wall.id""")
def wall_view(spark, d):
    m, w = A.mentions(spark, d), A.wall(spark, d)
    a = A.assessments(spark, d).select(F.col("item_id").alias("id"), "score", F.lit("r").alias("reason"), F.lit("p").alias("polarity"))
    hashes = spark.range(0, 40, 4).select(F.sha1(F.col("id").cast("string").cast("binary")).alias("hash"))
    covers = hashes.select("hash", F.concat(F.lit("p"), F.left("hash", F.lit(4))).alias("preview"))
    got = report.wall_view(m.withColumn("assessment_id", F.col("id")), stories.stories(w), a, covers)
    return got.select("id", "replicas", "score", "preview")


@query("""& k AS (SELECT round_even(100 * count(*) FILTER (score >= 5) / nullif(count(score), 0), 0)::BIGINT AS p FROM wall LEFT JOIN assessment ON item_id = id) SELECT p AS favourable_pct, p >= 75 AS met FROM k""")
def kpi_goal(spark, d):
    return report.goal(A.scored_wall(spark, d))


@query(f"""& {CLOSURE.replace('WITH RECURSIVE ', '')}, {TOPIC}, c AS (SELECT story_id, topic, sum(round(greatest(0.2, 1.0 - 0.2 * position), 2)::DOUBLE) AS c FROM story JOIN topic USING (id) GROUP BY 1, 2),
m AS (SELECT story_id, topic FROM c QUALIFY row_number() OVER (PARTITION BY story_id ORDER BY round(c, 6) DESC, topic) = 1), r AS (SELECT story_id, sum(CASE WHEN id % 6 > 0 THEN id % 50 END)::BIGINT AS summed_reach FROM story GROUP BY 1)
SELECT story_id, topic AS main_topic, summed_reach FROM r LEFT JOIN m USING (story_id)""")
def story_facts(spark, d):
    w = A.wall(spark, d)
    topics = A.topic_bridge(spark, d).select("id", "topic", "confidence")
    reach = w.select("id", F.when(F.col("id") % 6 > 0, F.col("id") % 50).alias("reach"))
    return report.story_facts(stories.stories(w), topics, reach)


TOPIC_TABLE = [(7, "beaches", 3, False), (8, "tenders", 1, True), (9, "harbour", 2, True), (10, "nothing", 0, True)]


@query("""SELECT id, slug FROM (VALUES (7, 'beaches', 3, false), (8, 'tenders', 1, true), (9, 'harbour', 2, true), (10, 'nothing', 0, true)) t(id, slug, p, a) WHERE a""")
def active_topics(spark, d):
    return report.active_topics(spark.createDataFrame(TOPIC_TABLE, "id int, slug string, position int, active boolean")).select("id", "slug")


@query(f"""& {TOPIC} SELECT id AS mention_id, CASE topic WHEN 'beaches' THEN 7 WHEN 'tenders' THEN 8 ELSE 9 END AS topic_id, round(greatest(0.2, 1.0 - 0.2 * position), 2)::DOUBLE AS confidence FROM topic WHERE topic <> 'events'""")
def mention_topics(spark, d):
    """Slugs to topic ids; one of the tagged slugs is no topic."""
    from newsloom.functions.scoring import topics

    tagged = A.wall(spark, d).select("id", topics("title", "summary", A.TOPICS).alias("topics"))
    return C.mention_topics(tagged, spark.createDataFrame(TOPIC_TABLE, "id int, slug string, position int, active boolean"))


def _published(spark, d):
    """Scored mentions of the wall with topics and the size of their stories; written, since reports read it many times."""
    from newsloom.functions.scoring import topics
    from newsloom.plans.catalog import _story_sizes

    sized = _story_sizes(spark, d).withColumn("topics", topics("title", "summary", A.TOPICS))
    return Scratch(spark, "published").write(sized.drop("summary", "body"), "items")


SIZED = f"""{CLOSURE}, {TOPIC}, size AS (SELECT story_id, count(*) AS replicas FROM story GROUP BY 1), tags AS (SELECT id, string_agg(topic, ',' ORDER BY position) AS e FROM topic GROUP BY id),
item AS (SELECT wall.*, score, replicas, coalesce(e, '') AS e FROM wall JOIN story ON story.id = wall.id JOIN size USING (story_id) LEFT JOIN assessment ON item_id = wall.id LEFT JOIN tags ON tags.id = wall.id)"""


@query(f"""& {SIZED} SELECT id, title AS t, outlet AS v, strftime(published, '%Y-%m-%dT%H:%M:%S') AS d, published_precision AS p, score AS n, replicas AS r, e FROM item""")
def payload_items(spark, d):
    """The published items under their short keys."""
    return report.short_items(_published(spark, d)).withColumn("e", F.array_join("e", ","))


def _period_sql(days: int) -> str:
    own = f"own AS (SELECT * FROM item WHERE CAST(published AS DATE) BETWEEN (SELECT greatest(max(CAST(published AS DATE)), DATE '{AS_OF}') FROM item) - {days - 1} AND (SELECT greatest(max(CAST(published AS DATE)), DATE '{AS_OF}') FROM item))"
    return f"""{own}, h AS (SELECT string_agg(id, ',' ORDER BY replicas DESC, published, id) AS highlights FROM (SELECT * FROM own ORDER BY replicas DESC, published, id LIMIT 4)), w AS (SELECT (SELECT id FROM own WHERE score <= 4 ORDER BY score, published DESC, id LIMIT 1) AS attention)
SELECT count(*) AS mentions, round_even(avg(score), 2) AS mean_score, round_even(100 * count(*) FILTER (score >= 5) / nullif(count(score), 0), 0)::BIGINT AS favourable_pct, (SELECT coalesce(highlights, '') FROM h) AS highlights, (SELECT attention FROM w) AS attention FROM own"""


@query(f"& {SIZED}, {_period_sql(7)}")
def payload_week(spark, d):
    items = _published(spark, d)
    return _head(items, spark, d, "week")


@query(f"& {SIZED}, {_period_sql(30)}")
def payload_month(spark, d):
    return _head(_published(spark, d), spark, d, "month")


def _head(items, spark, d, part: str):
    head = report.payload_head(items, A.outlets(spark, d), F.to_date(F.lit(AS_OF)))
    s = F.col(part)
    return head.select(s["mentions"].alias("mentions"), s["mean_score"].alias("mean_score"), s["favourable_pct"].alias("favourable_pct"), F.array_join(F.coalesce(s["highlights"].cast("array<string>"), F.array().cast("array<string>")), ",").alias("highlights"), s["attention"].alias("attention"))


@query(f"""& {SIZED}, b AS (SELECT min(CAST(published AS DATE)) AS low, greatest(max(CAST(published AS DATE)), DATE '{AS_OF}') AS last FROM item),
days AS (SELECT unnest(generate_series(greatest(low, last - 59)::TIMESTAMP, last::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM b), per AS (SELECT CAST(published AS DATE) AS day, count(*) AS n FROM item GROUP BY 1)
SELECT (SELECT count(*) FROM item) AS mentions, (SELECT string_agg(day || ':' || coalesce(n, 0), ' ' ORDER BY day) FROM days LEFT JOIN per USING (day)) AS days, (SELECT string_agg(DISTINCT domain || ':' || type, ' ' ORDER BY domain || ':' || type) FROM outlet WHERE domain IN (SELECT outlet FROM wall)) AS outlets""")
def payload_head(spark, d):
    """The document's head: what does not grow with the wall; its items are payload_items."""
    head = report.payload_head(_published(spark, d), A.outlets(spark, d), F.to_date(F.lit(AS_OF)))
    days = F.array_join(F.transform("days", lambda x: F.concat(x["day"].cast("string"), F.lit(":"), x["n"].cast("string"))), " ")
    outlets = F.array_join(F.array_sort(F.transform("outlets", lambda x: F.concat(x["domain"], F.lit(":"), x["type"]))), " ")
    return head.select(F.col("kpi.mentions").alias("mentions"), days.alias("days"), outlets.alias("outlets"))


@query()
def payload(spark, d):
    """The whole document as one text, for walls that a reader loads at once."""
    return report.payload(_published(spark, d), A.outlets(spark, d), F.to_date(F.lit(AS_OF)))
