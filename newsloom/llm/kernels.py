"""Vectorised word and n-gram hashing over Arrow string buffers.

A word is found and hashed from the UTF-8 bytes of a whole batch at once:
separators are ASCII, so byte-wise splitting equals character-wise splitting.
Word hashes have 64 bits; wider identities are built from two differently
mixed sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_powers = np.ones(1, U)
_inverses = np.ones(1, U)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything but ASCII letters, digits and bytes of non-ASCII characters.
NON_ALNUM = np.array([not (chr(b).isalnum() if b < 128 else True) for b in range(256)])
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)


def _grow(n: int) -> None:
    global _powers, _inverses
    if n > len(_powers):
        n = max(n, 2 * len(_powers))
        for name, base in (("_powers", _BASE), ("_inverses", _BASE_INVERSE)):
            x = np.full(n, base, U)
            x[0] = 1
            globals()[name] = np.multiply.accumulate(x)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x + U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string array; null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    n, (_, offsets, data) = len(column), column.buffers()
    o = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    d = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return d[o[0] : o[-1]], o - o[0]


def words(column: pa.Array, separators: np.ndarray = SPACE, fold: np.ndarray = SAME) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and n + 1 offsets into them by text."""
    data, offsets = strings(column)
    n = len(data)
    if not n:
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    word = ~separators[data]
    before = np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, word[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    start = np.flatnonzero(word & ~before)
    end = np.flatnonzero(word & ~after) + 1
    return span_hashes(data, start, end, fold), np.searchsorted(start, offsets)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: np.ndarray = SAME) -> np.ndarray:
    """A hash of each run of bytes from start to end."""
    n = len(data)
    _grow(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum((fold[data].astype(U) + U(1)) * _powers[:n], out=total[1:])
    return mix((total[end] - total[start]) * _inverses[start] + (end - start).astype(U))


def ngrams(hashes: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """Hash of the ``length`` words from each place on, as far as they reach."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.zeros(n, U)
    for k in range(length):
        out += hashes[k : k + n] * U(int(mix(np.array([salt * 1000 + k + 1], U))[0]) | 1)
    return mix(out)


def doubled(hashes: np.ndarray, length: int) -> np.ndarray:
    """From n-gram hashes of ``length``, those of twice the length."""
    n = len(hashes) - length
    if n <= 0:
        return np.zeros(0, U)
    return mix(hashes[:n] * U(0xD6E8FEB86659FD93) + mix(hashes[length : length + n]))


def slices(batch: pa.RecordBatch, column: str, most: int = 500_000) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``most`` bytes of text at most, a longer text alone."""
    data = batch.column(column)
    size = pc.fill_null(pc.binary_length(data), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    total = np.concatenate([[0], np.cumsum(size)])
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_column(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32), pa.int32()), pa.array(values, kind))


def squeeze(column: pa.Array) -> pa.Array:
    """Strings as zstd frames, for a shuffle; null stays null."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    return pa.array([None if t is None else pack(t.encode()) for t in column.to_pylist()], pa.binary())


def unsqueeze(column: pa.Array) -> pa.Array:
    """The strings again; null as empty."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array(["" if t is None else unpack(t).decode() for t in column.to_pylist()], pa.large_string())


def unsqueeze_nulls(column: pa.Array) -> pa.Array:
    """The strings again; null stays null."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([None if t is None else unpack(t).decode() for t in column.to_pylist()], pa.string())
