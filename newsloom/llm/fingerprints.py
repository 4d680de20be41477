"""Bottom-k sketches of word shingles, by DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def let(value: Column, use) -> Column:
    """use(value), value being computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _words(text: Column) -> Column:
    """A hash of each word, in their order."""
    found = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+"), "")
    return F.transform(found, lambda w: F.xxhash64(w))


def _least(h: Column, k: int, width: int) -> Column:
    """The k smallest hashes of the distinct shingles of hashed words."""
    n = F.size(h)
    whole = F.when(n > 0, F.array(F.aggregate(h, F.lit(0).cast("long"), lambda a, x: F.xxhash64(a, x)))).otherwise(F.array().cast("array<long>"))
    many = F.transform(F.sequence(F.lit(1), F.greatest(n - width + 1, F.lit(1))), lambda i: F.xxhash64(*(F.element_at(h, i + j) for j in range(width))))
    return F.slice(F.sort_array(F.array_distinct(F.when(n >= width, many).otherwise(whole))), 1, k)


def bottom_k(text: Column, k: int = 128, width: int = 5) -> Column:
    """Sorted array<long>: the k smallest hashes of the distinct shingles.

    Words are runs without ASCII white space, lower-cased. Fewer words than
    width: the whole sequence is one shingle. No words or null: empty.
    """
    return let(_words(text), lambda h: _least(h, k, width))


def with_sketch(rows: DataFrame, text: str, name: str, k: int = 128, width: int = 5) -> DataFrame:
    """rows with bottom_k of a column beside the others, in two projections.

    No function of arrays stands inside another's lambda: those are interpreted
    by recursion, however deep they stand.
    """
    return rows.withColumn("_words", _words(F.col(text))).withColumn(name, _least(F.col("_words"), k, width)).drop("_words")


def merge(a: Column, b: Column, k: int = 128) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated share of common shingles among all of both; 1.0 for two empty sketches."""
    union = merge(a, b, k)
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(F.array_intersect(a, b), union)) / F.size(union))


def distinct_shingles(a: Column, k: int = 128) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) / share)


def containment(a: Column, b: Column, k: int = 128) -> Column:
    """Estimated share of a's shingles that b has too; null if a is empty."""
    both = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) > 0, F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """Sixteen hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 128, width: int = 5) -> DataFrame:
    """id, n_chars, sketch of every row."""
    return docs.select(docs[id_col], F.length(F.coalesce(docs[text_col], F.lit(""))).cast("long").alias("n_chars"), bottom_k(docs[text_col], k, width).alias("sketch"))


def _bounds(rows: DataFrame, n: int, ranges: int, sample: int) -> list:
    """The least (id, hash) of each range but the first, from about ``sample`` of n rows, chosen by hash."""
    part = (1 << 30) * sample // n if n > sample else 1 << 30
    chosen = rows.where(F.pmod(F.xxhash64("_key", "_hash", F.lit(9)), F.lit(1 << 30)) < part)
    held = sorted((r["_key"], r["_hash"]) for r in chosen.select("_key", "_hash").collect())
    return sorted({held[k * len(held) // ranges] for k in range(1, ranges)}) if held else []


def _range_of(bounds: list) -> Column:
    """The number of bounds that are no greater than a row's (_key, _hash), by halving."""
    if not bounds:
        return F.lit(0)
    longs = lambda found: F.split(F.lit(",".join(map(str, found))), ",").cast("array<long>")  # noqa: E731  one literal
    keys, hashes = (longs([b[i] for b in bounds]) for i in (0, 1))
    steps = longs([1 << k for k in reversed(range(len(bounds).bit_length()))])

    def on(at: Column, step: Column) -> Column:
        to = at + step
        k, h = F.get(keys, to - 1), F.get(hashes, to - 1)
        return F.when((to <= len(bounds)) & ((k < F.col("_key")) | ((k == F.col("_key")) & (h <= F.col("_hash")))), to).otherwise(at)

    return F.aggregate(steps.cast("array<int>"), F.lit(0), on)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 128, width: int = 5, rows_per_range: int = 1024, most_ranges: int = 1 << 15) -> DataFrame:
    """Each row's fingerprint, its edited text's, and its likeness to both that and the next row.

    The edited text has its last half replaced by the beginning of the next
    row's (descending id; after the last one the first). Rows are cut into
    ranges of their order that hold about as many rows each: ``rows_per_range``
    or more, beyond ``most_ranges`` ranges. Their bounds come from a sample of
    64 ids for each (2^18 at most), as for a sort, and only decide where a row
    is worked on; rows of one id may fall to several, by a hash of their texts. A
    range's last row is also dealt to the range above, so that one window by
    range finds every next row: a text moves once (a boundary row twice), and
    no task orders all rows.

    Null text: an empty one. Ids are cast to long, any of them; what is no
    number counts as null. Rows of a null id stay among those of the smallest
    long. Rows of equal id follow in the order of a hash of their texts. A
    single row is its own next. An empty table gives an empty one; other
    columns are ignored.
    """
    rows = docs.select(docs[id_col].try_cast("long").alias("_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_text"))
    rows = rows.select("*", F.coalesce("_id", F.lit(-(1 << 63))).alias("_key"), F.xxhash64("_text").alias("_hash"))
    n = rows.count()
    ranges = max(8, min(most_ranges, n // rows_per_range))
    bounds = _bounds(rows, n, ranges, min(64 * ranges, 1 << 18))
    ranged = rows.withColumn("_range", _range_of(bounds))
    # of each range, its greatest row goes to the next range that has rows, and the last one's to the first
    tops = ranged.groupBy("_range").agg(F.max(F.struct("_key", "_hash")).alias("top"))
    order = Window.orderBy("_range")  # ``most_ranges`` rows at most
    tops = tops.select("top", F.coalesce(F.lead("_range").over(order), F.min("_range").over(Window.partitionBy())).alias("_above"))
    tops = tops.select(F.col("top._key").alias("_top"), F.col("top._hash").alias("_h"), "_above")
    dealt = ranged.join(F.broadcast(tops), (F.col("_key") == F.col("_top")) & (F.col("_hash") == F.col("_h")), "left")
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("ghost"))
    dealt = dealt.select("_id", "_text", "_key", "_hash", F.explode(F.when(F.col("_above").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("_above").alias("r"), F.lit(True).alias("ghost"))))).alias("at"))
    dealt = dealt.select("_id", "_text", "_key", "_hash", "at.r", "at.ghost").repartition("r")
    sketched = with_sketch(dealt, "_text", "_sketch", k, width)
    before = Window.partitionBy("r").orderBy(F.desc("ghost"), "_key", "_hash")
    nexts = sketched.withColumns({"_next": F.lag("_text").over(before), "_next_sketch": F.lag("_sketch").over(before)}).where("NOT ghost")
    n = F.length("_text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.expr("left(_text, length(_text) - cast(floor(length(_text) / 2) as int))"), F.when(half > 0, F.expr("left(_next, cast(floor(length(_text) / 2) as int))")).otherwise(F.lit("")))
    out = with_sketch(nexts.select("_id", n.cast("long").alias("n_chars"), "_sketch", "_next_sketch", edited.alias("_edited")), "_edited", "_edited_sketch", k, width)
    return out.select(
        F.col("_id").alias(id_col),
        "n_chars",
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("_sketch")).alias("fingerprint"),
        as_text(F.col("_edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("_sketch"), F.col("_edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("_sketch"), F.col("_next_sketch"), k).alias("near_next"),
    )
