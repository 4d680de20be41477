"""Quality selection by importance resampling of hashed n-gram models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.scratch import Scratch


def bucket_counts(docs: DataFrame, text_col: str, buckets: int) -> np.ndarray:
    """Counts of hashed words and word pairs of all texts: one number by bucket."""
    rows = docs.select(docs[text_col].cast("string").alias("_text"))

    def run(batches):
        import pyarrow as pa

        from newsloom.llm import kernels as K

        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in K.slices(batch, "_text"):
                total += np.bincount(hashed(part.column("_text"), buckets)[0], minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in rows.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log ratio of the two models by bucket; 0 everywhere without target texts."""
    if not target.sum():
        return np.zeros(len(raw))
    return np.log((target + 0.5) / (target + 0.5).sum()) - np.log((raw + 0.5) / (raw + 0.5).sum())


def hashed(column, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, then of all word pairs; of each its text's number."""
    from newsloom.llm import kernels as K

    words, at = K.words(column, fold=K.FOLD)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    pairs = K.ngrams(words, 2)
    same = text[1:] == text[:-1]
    both = np.concatenate([words, pairs[same] if len(pairs) else pairs])
    return (both % K.U(buckets)).astype(np.int64), np.concatenate([text, text[1:][same]])


def cut_value(keys: DataFrame, key: str, keep: int) -> tuple[int, int, int]:
    """(the keep-th greatest key, how many of those equal to it are kept, how many are equal), by counts alone.

    Keys are longs of 0 or more. The value is narrowed down by 16 bits at a
    time, so the driver sees 65,536 counts at most in each round.
    """
    bits = keys.select(F.col(key).alias("k"))
    low, left, equal = 0, keep, 0
    for shift in (48, 32, 16, 0):
        bucket = F.shiftrightunsigned(F.col("k"), shift)
        inside = bits if shift == 48 else bits.where(F.shiftrightunsigned(F.col("k"), shift + 16) == F.lit(low))
        counts = {r["b"]: r["count"] for r in inside.groupBy(bucket.alias("b")).count().collect()}
        for b in sorted(counts, reverse=True):
            if counts[b] >= left:
                low, equal = b, counts[b]
                break
            left -= counts[b]
    return low, left, equal


def greatest(rows: DataFrame, keys: list[str], keep: int) -> F.Column:
    """Whether a row is among the ``keep`` greatest by keys in order; exactly so many if the last key tells rows apart.

    Each key is looked at only among the rows that those before it leave tied
    at the cut, however many these are.
    """
    found, tied = F.lit(False), F.lit(True)
    for key in keys:
        cut, left, equal = cut_value(rows.where(tied), key, keep)
        found, tied = found | (tied & (F.col(key) > cut)), tied & (F.col(key) == cut)
        if left == equal:
            return found | tied
        keep = left
    return found | tied


def importance(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: float = 0.7, buckets: int = 20_000, typical: float | None = None, seed: int = 5) -> DataFrame:
    """Per row: id, log_weight, gumbel_key and kept: a sample of the share ``keep`` of rows.

    log_weight: log p(target) - log p(raw) of a row's hashed words and word
    pairs, the sum over all of them. Both models are counts over all rows of
    target and docs, smoothed by one half. ``typical``, an option: the mean
    over a row's n-grams times that number, as if every row had so many, where
    lengths should not decide. Added Gumbel noise (from a hash of id and seed)
    and the greatest keys make it a sample without replacement in proportion
    to the weights.

    Exactly round(keep * rows) are kept (half to even). Keys are compared to
    2^-24 and within 1e9 of 0; ties go by a hash of the id, then by row: of
    equal rows, as many as are due.

    Null or empty texts weigh 0 (the ratio of a text that tells nothing). Null
    ids share their noise. Repeated rows are drawn alike up to ties. Without
    target texts all weights are 0. Other columns are ignored; an empty table
    gives an empty one.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    raw, wanted = (bucket_counts(t, text_col, buckets) for t in (docs, target))
    ratio = log_ratios(wanted, raw)
    rows = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("_text"))
    kind = dict(rows.dtypes)["_id"]
    held = spark.sparkContext.broadcast(ratio)  # ``buckets`` numbers

    def run(batches):
        import pyarrow as pa

        from newsloom.llm import kernels as K

        for batch in batches:
            for part in K.slices(batch, "_text"):
                found, text = hashed(part.column("_text"), buckets)
                total = np.bincount(text, weights=held.value[found], minlength=part.num_rows).astype(float)
                if typical:
                    total *= typical / np.maximum(np.bincount(text, minlength=part.num_rows), 1)
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(total)], names=["_id", "log_weight"])

    uniform = (F.shiftrightunsigned(F.xxhash64("_id", F.lit(seed)), 11).cast("double") + 0.5) / F.lit(2.0**53)
    keyed = rows.mapInArrow(run, f"_id {kind}, log_weight double").withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform)))
    # doubles in the order of longs, by way of fixed point; the row's number is fixed by being written
    fixed = F.round(F.greatest(F.least(F.col("gumbel_key"), F.lit(1e9)), F.lit(-1e9)) * 2**24).cast("long") + F.lit(1 << 62)
    scored = scratch.write(keyed.withColumns({"_k": fixed, "_h": F.shiftrightunsigned(F.xxhash64("_id"), 1), "_row": F.monotonically_increasing_id()}), "keys")
    top = round(keep * scored.count())
    kept = greatest(scored, ["_k", "_h", "_row"], top) if top else F.lit(False)
    return scored.select(F.col("_id").alias(id_col), "log_weight", "gumbel_key", kept.alias("kept"))
