"""Logical views of the driver's tables.

No news data is at hand, so mentions, assessments and outlets are derived from
documents and labels by fixed rules, in Spark here and in SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import scoring

#: Invented vocabulary, made of words that the synthetic documents use.
REQUIRED = ["the", "les", "der", "los"]
PENALISED = ["thea", "théa", "erre", "ouer"]
TOPICS = {
    "harbour": ["thing", "ening"],
    "events": ["and", "und", "une"],
    "tenders": ["ation", "ering", "heit"],
    "beaches": ["with", "der", "de la"],
}
TERMS = [("the", "brand", "2024-01-01", None), ("und", "event", "2024-01-01", "2024-06-30"), ("les", "theme", "2024-02-01", None), ("los", "competitor", "2023-01-01", "2023-12-31")]

#: The same views for DuckDB; a query's SQL begins with them.
VIEWS = """
flat AS (SELECT doc_id, text, source, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents),
mention AS (
  SELECT doc_id AS id, array_to_string(string_split(t, ' ')[1:12], ' ') AS title, array_to_string(string_split(t, ' ')[13:52], ' ') AS summary, text AS body, source AS outlet,
    TIMESTAMP '2024-01-01 00:00:00' + to_hours(doc_id::INTEGER) AS published, CASE WHEN doc_id % 7 = 0 THEN 'approximate' ELSE 'exact' END AS published_precision,
    CASE WHEN doc_id % 11 = 0 THEN 'discarded' WHEN doc_id % 3 = 0 THEN 'raw' ELSE 'enriched' END AS state,
    CASE WHEN doc_id % 22 = 0 THEN 'relevance below cut' WHEN doc_id % 11 = 0 THEN 'off topic' END AS discard_reason,
    CASE WHEN doc_id % 5 <> 0 THEN sha1(CASE WHEN doc_id % 2 = 0 THEN doc_id % 40 ELSE doc_id END::VARCHAR) END AS cover_hash FROM flat),
wall AS (SELECT * FROM mention WHERE state <> 'discarded'),
assessment AS (SELECT doc_id AS item_id, (6 * quality + 2 * (1 - toxic) + doc_id % 3)::INTEGER AS score FROM labels),
outlet AS (SELECT DISTINCT source AS domain, CASE WHEN source = 'src0' THEN 'official' ELSE 'portal' END AS type FROM documents)"""


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    flat = F.split(F.trim(F.regexp_replace("text", "\\s+", " ")), " ")
    i = F.col("doc_id")
    return d.select(
        i.alias("id"),
        F.array_join(F.slice(flat, 1, 12), " ").alias("title"),
        F.array_join(F.slice(flat, 13, 40), " ").alias("summary"),
        F.col("text").alias("body"),
        F.col("source").alias("outlet"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + i * 3_600_000_000).alias("published"),
        F.when(i % 7 == 0, "approximate").otherwise("exact").alias("published_precision"),
        F.when(i % 11 == 0, "discarded").when(i % 3 == 0, "raw").otherwise("enriched").alias("state"),
        F.when(i % 22 == 0, "relevance below cut").when(i % 11 == 0, "off topic").alias("discard_reason"),
        F.when(i % 5 != 0, F.sha1(F.when(i % 2 == 0, i % 40).otherwise(i).cast("string").cast("binary"))).alias("cover_hash"),
    )


def wall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions(spark, sf_dir).where("state <> 'discarded'")


def assessments(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = (6 * F.col("quality") + 2 * (1 - F.col("toxic")) + F.col("doc_id") % 3).cast("int")
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("item_id"), score.alias("score"))


def outlets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("source").alias("domain")).distinct()
    return d.select("domain", F.when(F.col("domain") == "src0", "official").otherwise("portal").alias("type"))


def scored_wall(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, a = wall(spark, sf_dir), assessments(spark, sf_dir)
    return w.join(a, w.id == a.item_id, "left").drop("item_id")


def topic_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, topic, position, confidence) of wall mentions."""
    w = wall(spark, sf_dir).select("id", F.explode(scoring.topic_weights("title", "summary", TOPICS)).alias("t"))
    return w.select("id", "t.topic", "t.position", scoring.topic_confidence("t.position").alias("confidence"))
