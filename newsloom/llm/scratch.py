"""Ranks over written tables; the tables and components are the engine's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.tables import Scratch, connected_components, delete_path, scratch_root

__all__ = ["Scratch", "connected_components", "delete_path", "having", "rank_within", "scratch_root"]

#: Ids in one broadcast.
BLOCK = 500_000


def having(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows of docs with one of the ids: by broadcast up to BLOCK ids, by a shuffled semi-join beyond."""
    few = ids.count() <= BLOCK
    return docs.join(F.broadcast(ids) if few else ids.hint("merge"), id_col, "left_semi")


def rank_within(df: DataFrame, keys: list[str], order: list, salt_of: str, buckets: Column | None, to: str) -> DataFrame:
    """Adds ``to``: a number from 0 within keys, gapless and unique.

    A key's rows are dealt by a hash of ``salt_of`` into as many parts as the
    column ``buckets`` says for the key, so that parts stay of one size (None:
    the values of ``salt_of`` are the parts); a part is numbered by a window
    of its own and moved by the sizes of the parts before it. So a key with a
    third of all rows is numbered by many tasks. The order is by part, then
    ``order``.
    """
    salted = df.withColumn("_part", F.col(salt_of) if buckets is None else F.pmod(F.xxhash64(salt_of), buckets))
    sizes = salted.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = Window.partitionBy(*keys, "_part").orderBy(*order)
    numbered = salted.withColumn("_own", F.row_number().over(own) - 1)
    return numbered.join(sizes, [*keys, "_part"]).withColumn(to, F.col("_own") + F.col("_before")).drop("_own", "_before", *(["_part"] if salt_of != "_part" else []))
