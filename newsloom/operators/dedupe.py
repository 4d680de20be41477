"""Exact deduplication and first occurrences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.text import canonical_url


def with_dedupe_hash(items: DataFrame, url: str = "url") -> DataFrame:
    """Adds canonical_url and dedupe_hash (sha1 of it)."""
    return items.withColumn("canonical_url", canonical_url(url)).withColumn("dedupe_hash", F.sha1(F.col("canonical_url").cast("binary")))


def hard_dedupe(items: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key; ``min`` of an ordering struct is combined before the shuffle."""
    rest = [c for c in items.columns if c not in keys]
    least = items.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return least.select(*keys, *(F.col(f"_row.`{c}`").alias(c) for c in rest)).select(*items.columns)


def new_only(items: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Items whose keys are not stored yet."""
    return items.join(stored.select(*keys).distinct(), keys, "left_anti")


def first_per(items: DataFrame, key: str, order: list) -> DataFrame:
    """First row of each key in an order, by a window."""
    return items.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")
