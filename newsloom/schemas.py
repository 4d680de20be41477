"""Tables of the engine and the predicates their rows must satisfy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spark DDL by table.
TABLES = {
    "schema_version": "version int, applied_at timestamp, note string",
    "config": "key string, value string",
    "outlet": "id bigint, domain string, name string, type string, state string, city string, monthly_reach bigint, reach_source string, reach_nature string, weight double, active boolean",
    "topic": "id bigint, slug string, name string, light string, dark string, sensitive boolean, position int, active boolean",
    "tracked_term": "id bigint, term string, type string, variants array<string>, required boolean, valid_from date, valid_to date",
    "saved_query": "id bigint, collector string, topic_id bigint, expression string, params string, active boolean, last_at timestamp, cursor string",
    "collection_run": "id bigint, collector string, query_id bigint, params string, started timestamp, ended timestamp, status string, found int, new int, cost_units double, error string",
    "story": "id bigint, canonical_title string, first_pub timestamp, last_pub timestamp, n_mentions bigint, main_topic_id bigint, summed_reach bigint, mean_score double",
    "mention": "id bigint, client_id bigint, channel string, collector string, run_id bigint, url string, canonical_url string, dedupe_hash string, title string, title_simhash bigint, title_bucket int, summary string, body string, author string, outlet_id bigint, published timestamp, published_raw string, published_precision string, cover_url string, cover_hash string, cover_status string, story_id bigint, relevance double, state string, discard_reason string, assessment_id bigint, raw string, created timestamp, updated timestamp",
    "mention_topic": "mention_id bigint, topic_id bigint, confidence double",
    "mention_term": "mention_id bigint, term_id bigint, occurrences int",
    "metric": "id bigint, mention_id bigint, measured timestamp, views bigint, likes bigint, comments bigint, shares bigint, saves bigint, engagement double, estimated_reach bigint, nature string, source string",
    "rubric": "id bigint, version string, title string, text string, prompt string, model string, temperature double, bands string, hash string, valid_from date, valid_to date, author string",
    "assessment": "id bigint, mention_id bigint, rubric_id bigint, score int, band string, polarity string, reason string, evidence array<string>, confidence string, model string, tokens_in bigint, tokens_out bigint, cost double, origin string, reviewer string, previous_score int, created timestamp",
    "calibration": "id bigint, rubric_id bigint, gold_set string, n bigint, mae double, band_accuracy double, kappa double, run_at timestamp, detail string",
    "quoted_number": "id bigint, mention_id bigint, story_id bigint, indicator string, value double, unit string, nature string, declared_by string, method string, sentence string, confidence string, conflict string, verified timestamp, verified_by string",
    "edition": "id bigint, type string, period_from date, period_to date, event string, rubric_id bigint, terms string, sources string, limits string, metrics string, body string, made timestamp, hash string, key string",
    "edition_item": "edition_id bigint, mention_id bigint, frozen_score int, frozen_polarity string, frozen_reach bigint",
    "alert": "id bigint, mention_id bigint, rule string, level string, fired timestamp, sent timestamp, recipients string, body string",
    "queue": "id bigint, task string, mention_id bigint, priority int, attempts int, next_at timestamp, error string",
    "engine_state": "key string, value string, encrypted boolean, updated timestamp",
    "cover": "hash string, width int, height int, bytes bigint, mime string, origin_url string, preview string, fetched timestamp, format string",
    "log": "id bigint, at timestamp, level string, origin string, message string",
}

#: Values that columns may hold, by table; null is allowed.
ALLOWED = {
    "outlet": {"type": ["portal", "newspaper", "tv", "radio", "blog", "magazine", "network", "aggregator", "official", "ai"], "reach_nature": ["measured", "declared", "estimated"]},
    "tracked_term": {"type": ["brand", "event", "person", "competitor", "theme", "negative"]},
    "collection_run": {"status": ["running", "ok", "failed", "partial"]},
    "mention": {
        "channel": ["press", "instagram", "facebook", "youtube", "tiktok", "x", "tv", "radio", "podcast", "ai", "manual"],
        "published_precision": ["exact", "approximate", "unknown"],
        "cover_status": ["pending", "ok", "absent", "failed", "generated"],
        "state": ["raw", "enriched", "assessed", "published", "discarded"],
    },
    "metric": {"nature": ["measured", "declared", "estimated"]},
    "assessment": {"polarity": ["positive", "neutral", "negative"], "confidence": ["high", "medium", "low"], "origin": ["auto", "human", "revised"]},
    "quoted_number": {"nature": ["measured", "declared", "estimated"], "confidence": ["high", "medium", "low"]},
    "edition": {"type": ["daily", "weekly", "monthly", "event"]},
    "alert": {"level": ["info", "warning", "critical"]},
    "queue": {"task": ["enrich", "cover", "assess", "transcribe", "geo", "metric"]},
    "cover": {"format": ["webp", "jpeg", "png", "svg"]},
}


def checks(table: str) -> Column:
    """Whether a row's values are allowed; a score must be within 0 to 10."""
    out = F.lit(True)
    for column, values in ALLOWED.get(table, {}).items():
        out = out & (F.col(column).isNull() | F.col(column).isin(values))
    if table == "assessment":
        out = out & F.coalesce(F.col("score").between(0, 10), F.lit(False))
    return out


def split_valid(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows). Checks of columns that df lacks are left out."""
    for column in ALLOWED.get(table, {}):
        if column not in df.columns:
            df = df.withColumn(column, F.lit(None).cast("string"))
    return df.where(checks(table)), df.where(~checks(table))


def create_all(spark, database: str = "default") -> list[str]:
    """Create the tables that are not there yet; calling it again changes nothing."""
    for name, ddl in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`nl_{name}` ({ddl}) USING parquet")
    return [f"nl_{name}" for name in TABLES]
