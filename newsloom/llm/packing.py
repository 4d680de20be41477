"""Packing of token sequences by exact complements, then best fit."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.scratch import Scratch, rank_within
from newsloom.llm.token_counts import BYTE_BPE


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = BYTE_BPE, end_id: int = 2, size: int = 1024, path: str | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the columns ``carry`` of its row.

    A document's ids, of the tokenizer's library, and then end_id. Only longer
    ones than size are cut: all pieces but the first have size ids. An empty or
    null text is end_id alone.
    """
    rows = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("_text"), *carry)
    kinds = dict(rows.dtypes)

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        from newsloom.llm.encoding import encoder
        from newsloom.llm.kernels import slices

        own = encoder(tokenizer, path)
        for batch in batches:
            for part in slices(batch, "_text", 1_000_000):
                found, at = own.ids(part.column("_text"))
                ids = np.insert(found, at[1:], end_id).astype("<u4")
                ends = at[1:] + np.arange(1, len(at))
                n = np.diff(ends, prepend=0)
                count = -(-n // size)
                row = np.repeat(np.arange(len(n)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                # the first piece holds what is left over by whole ones
                to = n[row] - (count[row] - 1 - piece) * size
                start = np.where(piece > 0, to - size, 0)
                base = (ends - n)[row]
                crc = [zlib.crc32(ids[a:b]) for a, b in zip((base + start).tolist(), (base + to).tolist(), strict=True)]
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("_id").take(take), pa.array(piece.astype(np.int32)), *(pa.array(x, pa.int64()) for x in (start, to - start, crc)), *(part.column(c).take(take) for c in carry)], names=[id_col, "piece", "start", "length", "ids_crc32", *carry])

    return rows.mapInArrow(run, f"`{id_col}` {kinds['_id']}, piece int, start long, length long, ids_crc32 long" + "".join(f", `{c}` {kinds[c]}" for c in carry))


class Complements:
    """The combinations of one, two or three lengths by their sum, under counts that only fall.

    Singles are looked up by length; pairs are indexed by sum, longest part
    first; a triple is its longest part and an indexed pair of the rest. Of
    each sum an iterator goes over its combinations once: one whose lengths
    have run out never comes back.
    """

    def __init__(self, left: Counter, size: int):
        self.left, lengths = left, sorted(left)
        self.pairs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for k, a in enumerate(lengths):
            for b in lengths[: k + 1]:
                if a + b > size:
                    break
                self.pairs[a + b].append((a, b))
        self.lengths = lengths
        self.open: dict[int, tuple[Iterator, list]] = {}

    def _all(self, total: int) -> Iterator[tuple[int, ...]]:
        """Combinations of a sum: one length, pairs, triples; of longest parts first."""
        if total in self.left:
            yield (total,)
        yield from reversed(self.pairs.get(total, ()))
        for a in reversed(self.lengths[: bisect_right(self.lengths, total)]):
            if 3 * a < total:
                return
            if self.left[a] > 0:
                yield from ((a, b, c) for b, c in reversed(self.pairs.get(total - a, ())) if b <= a)

    def fill(self, total: int, beside: tuple[int, ...]) -> tuple[int, ...] | None:
        """The first combination of the sum that there is still, beside the lengths already taken."""
        source, kept = self.open.setdefault(total, (self._all(total), []))
        left, own = self.left, Counter(beside)
        there = lambda parts, taken: all(left[x] - taken[x] >= parts.count(x) for x in parts)
        kept[:] = [parts for parts in kept if there(parts, Counter())]
        for parts in kept:
            if there(parts, own):
                return parts
        for parts in source:
            if there(parts, Counter()):
                kept.append(parts)
                if there(parts, own):
                    return parts
        return None


def plan(counts: dict[int, int], size: int = 1024) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, number of such sequences), for counts by length.

    The longest length left opens sequences. A gap that one length, a pair or
    a triple of available lengths fills exactly is filled so, and as many such
    sequences are made as the counts allow. A gap without an exact complement
    takes the longest length that fits, and what is left of it is tried for
    exact complements again, until nothing fits. Each pattern uses up one of
    its lengths, so there are at most as many patterns as lengths, however many
    pieces there are.
    """
    left = Counter({k: v for k, v in counts.items() if v > 0})
    index, there = Complements(left, size), sorted(left)
    out: list[tuple[tuple[int, ...], int]] = []
    while there:
        parts, gap = (there[-1],), size - there[-1]
        while gap:
            if found := index.fill(gap, parts):
                parts += found
                break
            k = bisect_right(there, gap) - 1
            while k >= 0 and left[there[k]] <= parts.count(there[k]):
                k -= 1
            if k < 0:
                break
            parts, gap = (*parts, there[k]), gap - there[k]
        used = Counter(parts)
        n = min(left[x] // m for x, m in used.items())
        out.append((parts, n))
        for x, m in used.items():
            left[x] -= n * m
            if not left[x]:
                del there[bisect_left(there, x)]
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = BYTE_BPE, end_id: int = 2, size: int = 1024, path: str | None = None, rows_per_part: int = 8192, order: tuple[str, str] | None = None) -> DataFrame:
    """Every piece with sequence_id and offset: its sequence and place there.

    The counts by length (``size`` numbers at most) are all that the driver
    sees; it plans patterns of lengths, each with a number of sequences. A
    piece's rank among those of its length then tells its pattern, sequence
    and place, so pieces are assigned where they are; a length with very many
    pieces is ranked in parts of about ``rows_per_part``.

    order: two columns of docs, a part and a place within it, that put the rows
    in an order (as file and row number do). Pieces of a length are then used
    up in that order, part by part, and sequences are numbered by where their
    longest piece's row comes. Parts are ordered by length of their name, then
    by name. Without it the order is by a hash of the id.

    Null text: an empty one. Null ids, ties and repeated rows are packed like
    any row. An empty table gives an empty table. Other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "pack")
    if order:
        docs = docs.select(docs[id_col].alias(id_col), docs[text_col].alias(text_col), F.struct(F.length(order[0]).alias("n"), F.col(order[0]).alias("part")).alias("_part"), F.col(order[1]).cast("long").alias("_place"))
    carry = ("_part", "_place") if order else ()
    cut = scratch.write(pieces(docs, id_col, text_col, tokenizer, end_id, size, path, carry), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    slots, first = [], 0  # (length, parts to rank it in, rank from, rank to, first sequence, offset)
    used: Counter = Counter()
    for lengths, n in plan(counts, size):
        at = 0
        for x in lengths:
            slots.append((x, used[x], used[x] + n, first, at))
            used[x] += n
            at += x
        first += n
    # both tables are bounded by the number of lengths, not by the input
    table = spark.createDataFrame(slots, "length long, _from long, _to long, _first long, offset long")
    many = spark.createDataFrame([(x, -(-n // rows_per_part)) for x, n in counts.items()], "length long, _parts long")
    tie = [id_col, "piece", "start", "ids_crc32"]
    if order:
        ranked = rank_within(cut, ["length"], ["_place", *tie], "_part", None, "_rank")
    else:
        ranked = rank_within(cut.join(F.broadcast(many), "length"), ["length"], tie, id_col, F.col("_parts"), "_rank")
    placed = ranked.join(F.broadcast(table), ["length"]).where("_rank >= _from AND _rank < _to")
    out = placed.select(id_col, "piece", "start", "length", "ids_crc32", (F.col("_first") + F.col("_rank") - F.col("_from")).alias("sequence_id"), "offset", *carry)
    if not order:
        return out
    out = scratch.write(out, "placed")
    opening = out.where("offset = 0").select("sequence_id", *carry)
    numbered = rank_within(opening, [], ["_place", "sequence_id"], "_part", None, "_number").select("sequence_id", "_number")
    return out.join(numbered, "sequence_id").select(id_col, "piece", "start", "length", "ids_crc32", F.col("_number").alias("sequence_id"), "offset")
