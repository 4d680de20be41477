"""Seeds, exports and imports as JSON."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from newsloom.schemas import TABLES, split_valid


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """(key, value): the top-level entries of a JSON object file, values as JSON text."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "value"))


def config_value(config: DataFrame, key: str, ddl: str):
    """One entry of read_config, decoded by its DDL; None if it is not there."""
    found = config.where(F.col("key") == key).select(F.from_json("value", ddl).alias("v")).first()
    return found["v"] if found else None


def seed_vocabulary(spark: SparkSession, vocabulary: dict[str, list[str]]) -> DataFrame:
    """(topic, topic_position, word, word_position) in the order of the dictionary, which breaks ties."""
    rows = [(t, i, w, j) for i, (t, ws) in enumerate(vocabulary.items()) for j, w in enumerate(ws)]
    return spark.createDataFrame(rows, "topic string, topic_position int, word string, word_position int")


def saved_queries(sites: DataFrame, terms: DataFrame, collector: str = "search") -> DataFrame:
    """Every site with every term as one search expression."""
    return sites.crossJoin(F.broadcast(terms)).select(F.lit(collector).alias("collector"), F.concat(F.lit("site:"), "site", F.lit(" "), "term").alias("expression"))


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """A file with one JSON array of scores."""
    raw = spark.read.schema("id bigint, score int, reason string, evidence array<string>, confidence string").json(path, multiLine=True)
    return raw.withColumnRenamed("id", "mention_id")


def write_pending(items: DataFrame, path: str, limit: int = 500) -> None:
    """Unscored items, newest first: day and the first 400 characters of the summary. The limit is a work list's size."""
    work = items.where("score IS NULL").orderBy(F.desc("published"), "id").limit(limit)
    work.select("id", "title", F.date_format("published", "yyyy-MM-dd").alias("day"), F.substring("summary", 1, 400).alias("summary"), "outlet").write.mode("overwrite").json(path)


def export_jsonl(tables: dict[str, DataFrame], path: str, drop: tuple[str, ...] = ("body",)) -> None:
    """All tables as JSON lines, each with its table's name in _t."""
    lines = None
    for name, df in tables.items():
        own = df.drop(*drop).select(F.to_json(F.struct(F.lit(name).alias("_t"), "*")).alias("value"))
        lines = own if lines is None else lines.unionByName(own)
    if lines is not None:
        lines.write.mode("overwrite").text(path)


def export_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) of an export."""
    out = None
    for name, df in tables.items():
        own = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = own if out is None else out.unionByName(own)
    return out


def import_jsonl(spark: SparkSession, path: str, schemas: dict[str, str] | None = None, keys: dict[str, list[str]] | None = None, later: F.Column | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """(table by name, rejected lines).

    A line of an unknown table, of broken JSON or with values that a table
    does not allow is rejected. Of lines with equal keys the last one stays;
    ``later``, an expression over the parsed line r, tells the last one where
    the order of files does not.
    """
    schemas = schemas or TABLES
    lines = spark.read.text(path).where("trim(value) <> ''").withColumn("_at", F.monotonically_increasing_id())  # order within this read only
    named = lines.withColumn("_t", F.get_json_object("value", "$._t"))
    rejected = named.where(F.col("_t").isNull() | ~F.col("_t").isin(list(schemas))).select("value")
    out = {}
    for name, ddl in schemas.items():
        own = named.where(F.col("_t") == name).withColumn("r", F.from_json("value", f"{ddl}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}))
        broken = F.col("r").isNull() | F.col("r._corrupt").isNotNull()
        rejected = rejected.unionByName(own.where(broken).select("value"))
        at = F.struct(later.alias("l"), "_at").alias("_at") if later is not None else F.col("_at")
        rows = own.where(~broken).select("value", at, "r.*").drop("_corrupt")
        valid, bad = split_valid(rows, name)
        rejected = rejected.unionByName(bad.select("value"))
        columns = [f.split()[0] for f in _fields(ddl)]
        for k in [(keys or {}).get(name)] if (keys or {}).get(name) else []:
            rest = [c for c in columns if c not in k]
            valid = valid.groupBy(*k).agg(F.max_by(F.struct(*rest), "_at").alias("_row")).select(*k, *(F.col(f"_row.`{c}`").alias(c) for c in rest))
        out[name] = valid.select(*columns)
    return out, rejected


def _fields(ddl: str) -> list[str]:
    return [f.strip() for f in ddl.split(",")]


def cover_path(hash_: F.Column, extension: F.Column) -> F.Column:
    """Two levels of folders from a content hash."""
    return F.concat_ws("/", F.substring(hash_, 1, 2), F.substring(hash_, 3, 2), F.concat(hash_, F.lit("."), extension))


def image_size(data: bytes) -> tuple[int, int] | None:
    """Width and height of a PNG, JPEG or WEBP image from its headers alone; None if they do not tell."""
    word = lambda at, n, order="big": int.from_bytes(data[at : at + n], order)
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return word(16, 4), word(20, 4)
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP" and len(data) >= 30:
        kind = data[12:16]
        if kind == b"VP8X":
            return word(24, 3, "little") + 1, word(27, 3, "little") + 1
        if kind == b"VP8L":
            bits = word(21, 4, "little")
            return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
        if kind == b"VP8 ":
            return word(26, 2, "little") & 0x3FFF, word(28, 2, "little") & 0x3FFF
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(data) and data[at] == 0xFF:
            mark = data[at + 1]
            if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                return word(at + 7, 2), word(at + 5, 2)
            at += 1 if mark == 0xFF else 2 if mark == 0x01 or 0xD0 <= mark <= 0xD9 else 2 + word(at + 2, 2)
    return None


def covers(spark: SparkSession, path: str, most_bytes: int = 8 * 1024 * 1024, least: tuple[int, int] = (320, 180)) -> DataFrame:
    """Content hash, size, format and dimensions of landed images; pixels are not touched.

    Limits are looked at before anything is decoded: images over
    ``most_bytes``, of no known format or size, or smaller than ``least`` have
    status failed.
    """

    @pandas_udf("width int, height int")
    def sides(content: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([image_size(c) or (None, None) for c in content], columns=["width", "height"]).astype("Int32")

    files = spark.read.format("binaryFile").load(path)
    head = F.hex(F.substring("content", 1, 12))
    kind = F.when(head.startswith("89504E47"), "png").when(head.startswith("FFD8FF"), "jpeg").when(head.startswith("52494646") & head.endswith("57454250"), "webp")
    # a JPEG's sizes may come after long notes; the others' are at the beginning
    sized = files.withColumns({"format": kind, "s": sides(F.substring("content", 1, 1 << 18))})
    good = (F.col("length") <= most_bytes) & F.col("format").isNotNull() & (F.col("s.width") >= least[0]) & (F.col("s.height") >= least[1])
    return sized.select("path", F.sha1("content").alias("hash"), F.col("length").alias("bytes"), "format", "s.width", "s.height", F.when(good, "ok").otherwise("failed").alias("status"))


def covers_to_copy(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """Covers that published items need and the public folder lacks."""
    return wanted.where("cover_hash IS NOT NULL").select("cover_hash").distinct().join(present, "cover_hash", "left_anti")


def log_line(spark: SparkSession, as_of: F.Column, level: str, origin: str, message: str) -> DataFrame:
    """One row for the log table."""
    return spark.range(1).select(as_of.alias("at"), F.lit(level).alias("level"), F.lit(origin).alias("origin"), F.lit(message).alias("message"))
