"""Tables written between jobs, and connected components over them.

A multi-job operator cuts lineage by writing a table below the folder named in
``spark.checkpoint.dir``, which driver and executors share, so a lost executor
costs a re-read and never a recomputation of the whole job.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_roots: dict[str, SparkSession] = {}
#: While a table is written: an execution's shuffle files are dropped when it has ended, since nothing reads them again
#: then; and batches to Python workers are of 16 MB, since JVM and worker hold one each.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def scratch_root(spark: SparkSession) -> str:
    """This application's own folder below ``spark.checkpoint.dir``.

    Where that is unset, a session on one machine gets a folder of its own; on
    a cluster, where executors would not share one, it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="newsloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    root = f"{base.rstrip('/')}/newsloom-{spark.sparkContext.applicationId}"
    _roots[root] = spark
    return root


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _clean() -> None:
    for root, spark in _roots.items():
        try:
            delete_path(spark, root)
        except Exception:  # noqa: BLE001  the session has ended already
            pass


class Scratch:
    """Written intermediate tables of one operator call."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.n = 0

    def write(self, df: DataFrame, label: str = "t") -> DataFrame:
        """Write df and return it read back: its lineage is cut and its shuffle files are dropped."""
        self.n += 1
        path = f"{self.folder}/{self.n:03d}-{label}"
        held = {k: self.spark.conf.get(k) for k in _WRITING}
        try:
            for k, v in _WRITING.items():
                self.spark.conf.set(k, v)
            df.write.parquet(path)
        finally:
            for k, v in held.items():
                self.spark.conf.set(k, v)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete written tables that no later step reads."""
        for df in tables:
            delete_path(self.spark, df._scratch_path)


def connected_components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected links (a, b); component: smallest node.

    Alternating large-star and small-star steps until every node hangs on one
    smallest node, which takes a number of rounds that grows with the logarithm
    of the longest chain. The smallest neighbour is found by a partially
    aggregated group-by and joined back, so that a node with very many links is
    never gathered into one task. Nodes come from links only; a link (a, a)
    makes none.
    """
    edges = scratch.write(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # large star: larger neighbours of u are tied to the least of u's neighbourhood
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: u and its smaller neighbours are tied to the least one
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small_least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small_least.select("u", F.col("m").alias("v")))
        after = scratch.write(small.where("u <> v").distinct(), "edges")
        scratch.drop(edges)
        edges = after
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every u of edges (u, v), u > v, has one v, and no v is a u."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("high")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("low"), F.lit(1).alias("high")))
    return ends.groupBy("node").agg(F.sum("low").alias("low"), F.max("high").alias("high")).where("low + high > 1 AND low > 0").isEmpty()
