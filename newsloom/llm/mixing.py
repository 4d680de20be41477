"""Mixing of sources to target weights by a Pfair schedule of their blocks."""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.scratch import rank_within


class Shares:
    """How target shares advance: every source by its weight until its blocks run out, then the others in proportion.

    After v units of a source's weight, sum(min(weight * v, blocks)) slots have
    passed, which is piecewise linear in v.
    """

    def __init__(self, blocks, weights):
        self.weights = np.asarray(weights, np.longdouble)
        ends = np.asarray(blocks, np.longdouble) / self.weights
        order = np.argsort(ends, kind="stable")
        self.ends = ends[order]
        self.live = np.cumsum(self.weights[order][::-1])[::-1]  # weight that advances up to each end
        self.begins = np.concatenate([[0], self.ends[:-1]])
        self.passed = np.concatenate([[0], np.cumsum(self.live * (self.ends - self.begins))[:-1]])

    def reached(self, source: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The (real) number of slots after which each source's share is count blocks."""
        v = count / self.weights[source]
        k = np.minimum(np.searchsorted(self.ends, v, "left"), len(self.ends) - 1)
        return self.passed[k] + self.live[k] * (v - self.begins[k])


def schedule(blocks, weights) -> np.ndarray:
    """The source (its number) of each slot, all blocks of all sources being placed.

    Block j (from 1) of a source is released at the slot in which the source's
    share reaches j - 1 and due at the end of the one in which it reaches j:
    with weight w of all that add up to 1, floor((j - 1) / w) and ceil(j / w).
    Of the released blocks the one due earliest runs. The shares fill every
    slot, so no block is late, and after any number of slots a source is less
    than one block from its share by the weights as given.
    """
    blocks = np.asarray(blocks, np.int64)
    total = int(blocks.sum())
    source = np.repeat(np.arange(len(blocks)), blocks)
    before = np.arange(total) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    if not total:
        return source
    shares = Shares(blocks, weights)
    # extended precision leaves errors of 1e-12 slots
    release = np.floor(shares.reached(source, before) + 1e-10).astype(np.int64)
    deadline = np.ceil(shares.reached(source, before + 1) - 1e-10).astype(np.int64)
    order = np.argsort(release, kind="stable")
    due = (deadline * total + np.arange(total))[order].tolist()
    release = release[order].tolist()
    waiting: list[int] = []
    out, k = np.empty(total, np.int64), 0
    for t in range(total):
        while k < total and (release[k] <= t or not waiting):
            heapq.heappush(waiting, due[k])
            k += 1
        out[t] = heapq.heappop(waiting) % total
    return source[out]


def target_weights(counts: dict, power: float = 0.7) -> dict:
    """Weights by source size raised to ``power``: below 1, small sources come earlier than they would."""
    return {s: float(n) ** power for s, n in counts.items()}


def source_counts(docs: DataFrame, source_col: str = "source", most_sources: int = 100_000) -> dict:
    """The number of rows of each source; ValueError if there are more than ``most_sources``, since such a column names no sources to mix."""
    found = docs.groupBy(source_col).count().limit(most_sources + 1).collect()
    if len(found) > most_sources:
        raise ValueError(f"column {source_col} has more than {most_sources} values")
    return {r[source_col]: r["count"] for r in found}


def mix(docs: DataFrame, weights: dict | None = None, id_col: str = "doc_id", source_col: str = "source", block: int = 16, most_blocks: int = 1 << 18, power: float = 0.7, rows_per_part: int = 8192, most_sources: int = 100_000, counts: dict | None = None) -> DataFrame:
    """All rows, with mix_position (from 0, gapless) in an order that keeps to the weights.

    A source's rows, in the order of an id hash, are cut into blocks of
    ``block`` rows, or of rows / ``most_blocks`` where that is more, so that
    the driver schedules a bounded number of blocks whatever the input. Every
    prefix of whole blocks holds of each source its share by the exact weights
    to less than one block. A source that has run out leaves its weight to the
    others. Without weights: sizes raised to ``power``. No row is dropped or
    repeated.

    The driver sees the number of rows of each source (``counts``, if known;
    see source_counts). Rows of a hot source are ranked by many tasks, about
    ``rows_per_part`` in each. A null source is a source of its own; sources without a positive given weight
    get the smallest one given. Null ids and repeated rows keep their places.
    An empty table gives an empty one. A column mix_position is replaced.
    """
    spark = docs.sparkSession
    counts = source_counts(docs, source_col, most_sources) if counts is None else counts
    if weights is None:
        weights = target_weights(counts, power)
    good = [float(w) for w in weights.values() if w and w > 0]
    least = min(good, default=1.0)
    names = sorted(counts, key=lambda s: (s is None, str(s)))
    own = [float(weights[s]) if weights.get(s) and weights[s] > 0 else least for s in names]
    rows = np.array([counts[s] for s in names], np.int64)
    block = max(block, -(-int(rows.sum()) // most_blocks))
    blocks = -(-rows // block)
    order = schedule(blocks, own)
    # a block's number within its source, its rows and the rows before it
    seen = np.empty(len(order), np.int64)
    by_source = np.argsort(order, kind="stable")
    seen[by_source] = np.arange(len(order)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    held = np.minimum(block, rows[order] - seen * block)
    start = np.cumsum(held) - held
    import pyarrow as pa

    # at most ``most_blocks`` blocks and one more for each source
    table = spark.createDataFrame(pa.table({"_source": pa.array(order, pa.int32()), "_block": pa.array(seen), "_start": pa.array(start)}))
    numbers = spark.createDataFrame([(s, i, -(-counts[s] // rows_per_part)) for i, s in enumerate(names)], f"`{source_col}` {docs.schema[source_col].dataType.simpleString()}, _source int, _parts long")
    named = docs.alias("d").join(F.broadcast(numbers).alias("n"), F.col(f"d.{source_col}").eqNullSafe(F.col(f"n.{source_col}"))).select("d.*", "_source", "_parts")
    ranked = rank_within(named, ["_source"], [F.xxhash64(id_col, F.lit(1)), id_col], id_col, F.col("_parts"), "_rank")
    placed = ranked.withColumn("_block", F.floor(F.col("_rank") / block)).join(F.broadcast(table), ["_source", "_block"])
    out = placed.withColumn("mix_position", F.col("_start") + F.col("_rank") % block)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c != "mix_position"], "mix_position")


def mixed_rows(docs: DataFrame, weights: dict | None = None, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", rows_per_file: int = 50_000, **more) -> DataFrame:
    """All rows of docs, with its columns, in the mixed order from part to part and file to file.

    As ``mix``. Parts are consecutive runs of positions, so no sampling is
    needed to range them. Texts travel as zstd frames.
    """
    spark = docs.sparkSession
    place = docs.columns.index(text_col)

    def on_text(change, kind: str):
        def run(batches):
            import pyarrow as pa

            from newsloom.llm import kernels as K

            for batch in batches:
                for part in K.slices(batch, text_col, 8_000_000):
                    yield pa.RecordBatch.from_arrays([*(getattr(K, change)(c) if i == place else c for i, c in enumerate(part.columns))], names=part.schema.names)

        return run, lambda df: ", ".join(f"`{f.name}` {kind if f.name == text_col else f.dataType.simpleString()}" for f in df.schema)

    run, ddl = on_text("squeeze", "binary")
    small = docs.mapInArrow(run, ddl(docs))
    counts = source_counts(docs, source_col)
    mixed = mix(small, weights, id_col, source_col, counts=counts, **more)
    total = sum(counts.values())
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // rows_per_file))
    dealt = mixed.repartitionById(parts, F.floor(F.col("mix_position") * parts / max(1, total)).cast("int")).sortWithinPartitions("mix_position").drop("mix_position")
    run, ddl = on_text("unsqueeze_nulls", "string")
    return dealt.mapInArrow(run, ddl(dealt))
