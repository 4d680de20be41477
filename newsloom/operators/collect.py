"""Seeding and one whole collection: both channels to new mentions, outlets, runs and tasks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.text import host_of
from newsloom.operators import lifecycle
from newsloom.operators.dedupe import hard_dedupe
from newsloom.operators.stories import assign_online, stories
from newsloom.schemas import TABLES

UNKNOWN_OUTLET = "unknown"


def _rows(spark: SparkSession, table: str, rows: list[dict]) -> DataFrame:
    """Configured rows with the table's columns, what they leave out being null."""
    schema = spark.createDataFrame([], TABLES[table]).schema
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def seed(spark: SparkSession, config: dict, tables: dict[str, DataFrame], as_of: Column) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables with the configuration in them, rows of each): seeding again changes nothing.

    config: settings {key: JSON text}, topics [{slug, name, light, dark,
    sensitive, position, queries}], sites and site_terms (every pair is a
    saved query), terms [{term, type, variants, required}], outlets [{domain,
    name, type, state, city, weight}]. Settings, topics and outlets are brought
    up to date by their keys; queries and terms are only added. What is new is
    active, what is there keeps its flag.
    """
    held = {name: tables.get(name, spark.createDataFrame([], TABLES[name])) for name in ("config", "topic", "saved_query", "tracked_term", "outlet")}
    settings = _rows(spark, "config", [{"key": k, "value": v} for k, v in config.get("settings", {}).items()])
    topics = _rows(spark, "topic", [{**t, "sensitive": bool(t.get("sensitive")), "active": True} for t in config.get("topics", ())]).withColumn("id", lifecycle.stable_id("slug"))
    outlets = _rows(spark, "outlet", [{"type": "portal", "weight": 1.0, **o, "active": True} for o in config.get("outlets", ())]).withColumn("id", lifecycle.stable_id("domain"))
    terms = _rows(spark, "tracked_term", [{"type": "theme", "variants": [], **t, "required": bool(t.get("required"))} for t in config.get("terms", ())])
    terms = terms.withColumns({"id": lifecycle.stable_id("term"), "valid_from": F.to_date(as_of)})
    asked = [{"collector": "search", "topic": t["slug"], "expression": q} for t in config.get("topics", ()) for q in t.get("queries", ())]
    asked += [{"collector": "sites", "topic": None, "expression": f"site:{s} {t}"} for s in config.get("sites", ()) for t in config.get("site_terms", ())]
    queries = spark.createDataFrame([(q["collector"], q["topic"], q["expression"]) for q in asked], "collector string, _slug string, expression string")
    queries = queries.withColumns({"topic_id": F.when(F.col("_slug").isNotNull(), lifecycle.stable_id("_slug")), "id": lifecycle.stable_id("collector", "expression"), "active": F.lit(True)}).drop("_slug")
    out = {
        "config": lifecycle.upsert(held["config"], settings, "key", ["value"]),
        "topic": lifecycle.upsert(held["topic"], topics, "slug", ["name", "light", "dark", "sensitive", "position"]),
        "outlet": lifecycle.upsert(held["outlet"], outlets, "domain", ["name", "type", "weight"]),
        "tracked_term": lifecycle.insert_new(held["tracked_term"], terms, ["term"]),
        "saved_query": lifecycle.insert_new(held["saved_query"], queries, ["collector", "expression"]),
    }
    from newsloom.sources.files import export_counts

    return out, export_counts({k: out[k] for k in ("topic", "saved_query", "tracked_term", "outlet")})


def queries_to_run(queries: DataFrame, collector: str | None = None, limit: int | None = None) -> DataFrame:
    """Active saved queries by collector and id; collector and limit are a run's arguments."""
    active = queries.where("active")
    if collector:
        active = active.where(F.col("collector") == collector)
    active = active.orderBy("collector", "id")
    return active.limit(limit) if limit else active


def both_channels(search: DataFrame, native: DataFrame) -> DataFrame:
    """Search and native items as one table, with _order (search first): columns that one side lacks are null."""
    return search.withColumn("_order", F.lit(0)).unionByName(native.withColumn("_order", F.lit(1)), allowMissingColumns=True)


def first_per_gid(found: DataFrame) -> DataFrame:
    """Of the items of all queries, the first of each gid by collector, query and place."""
    return hard_dedupe(found, ["gid"], ["collector", "query_id", "place"])


def collect(search: DataFrame, native: DataFrame, stored: DataFrame, outlets: DataFrame, required: list[str], penalised: list[str], as_of: Column, resolve: Callable[[DataFrame], DataFrame] | None = None, cut: float = 0.35) -> dict[str, DataFrame]:
    """One collection run: items (with outcome), outlets, tasks and runs.

    search: items of search feeds (collector, query_id, place, gid, title,
    feed_url, published, outlet_domain, ...). native: items of outlets' own
    feeds (gid, title, url, ...). stored: the mentions there are (id, channel,
    dedupe_hash, title, published, story_id). resolve gives search items their
    url or suspect_url; without it they have it.

    Repeated gids go first, then noise (by the title alone, which is all a
    search feed has), so that only what is left is resolved. Both channels then
    pass the same ingestion. New items join the stored story that is most
    similar, or one another. Discards are stored with their reason, under an
    outlet "unknown" if the feed names none.
    """
    from newsloom.functions.scoring import relevance

    one = first_per_gid(search)
    if resolve:
        low = relevance("title", F.lit(None).cast("string"), required, penalised) < cut
        one = resolve(one.where(~low)).unionByName(one.where(low), allowMissingColumns=True)
    told = lifecycle.ingest(both_channels(one, native), stored, required, penalised, cut)
    domain = F.coalesce(F.nullif(F.regexp_replace(F.lower("outlet_domain"), "^www\\.", ""), F.lit("")), F.when(F.col("state") != "discarded", F.nullif(host_of("url"), F.lit(""))), F.lit(UNKNOWN_OUTLET))
    told = told.withColumns({"id": lifecycle.stable_id("channel", "dedupe_hash"), "outlet_domain": domain})
    kept = told.where("outcome <> 'repeated'")
    fresh = kept.where("outcome = 'new'").select("id", "title", "published")
    joined = assign_online(fresh, stored)
    alone = fresh.join(joined.where("id = story_id").select("id"), "id")
    placed = joined.where("id <> story_id").unionByName(stories(alone))
    items = told.join(placed, "id", "left")
    return {
        "items": items,
        "outlets": lifecycle.with_outlets(outlets, kept),
        "tasks": lifecycle.follow_up(items.where("outcome = 'new'").select(F.col("id").alias("mention_id")), "enrich", 3),
        "runs": run_rows(search, native, items, as_of),
    }


def run_rows(search: DataFrame, native: DataFrame, items: DataFrame, as_of: Column, queries: DataFrame | None = None) -> DataFrame:
    """A closed run of each query and native feed: found, new, status, parameters.

    New items are told for native feeds only. With queries (id, collector),
    those that found nothing have a row too; a run that found nothing failed.
    """
    asked = search.groupBy("collector", "query_id").agg(F.count("*").cast("int").alias("found"))
    if queries is not None:
        asked = queries.select("collector", F.col("id").alias("query_id")).join(asked, ["collector", "query_id"], "left").withColumn("found", F.coalesce("found", F.lit(0)))
    asked = asked.select("collector", "query_id", F.to_json(F.struct(F.lit("30d").alias("window"))).alias("params"), "found", F.lit(None).cast("int").alias("new"))
    new = items.where("_order = 1 AND outcome = 'new'").groupBy("expression").agg(F.count("*").cast("int").alias("new"))
    own = native.groupBy("expression").agg(F.count("*").cast("int").alias("found")).join(new, "expression", "left")
    own = own.select(F.lit("native").alias("collector"), F.lit(None).cast("bigint").alias("query_id"), F.to_json(F.struct(F.col("expression").alias("feed"))).alias("params"), "found", F.coalesce("new", F.lit(0)).alias("new"))
    status = F.when(F.col("found") == 0, "failed").otherwise("ok")
    return asked.unionByName(own).withColumns({"status": status, "started": as_of, "ended": as_of})


def mention_topics(tagged: DataFrame, topics: DataFrame) -> DataFrame:
    """(mention_id, topic_id, confidence) of items with their topics' slugs in order; slugs that are no topic are left out."""
    from newsloom.functions.scoring import topic_confidence

    each = tagged.select(F.col("id").alias("mention_id"), F.posexplode("topics").alias("position", "slug"))
    known = each.join(F.broadcast(topics.select("slug", F.col("id").alias("topic_id"))), "slug")
    return known.select("mention_id", "topic_id", topic_confidence("position").alias("confidence"))
