"""Similarity hashes of titles."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from newsloom.functions.text import title_tokens


@pandas_udf(LongType())
def _simhash(tokens: pd.Series) -> pd.Series:
    """Majority bits of BLAKE2b-64 of three-word shingles; Spark has no BLAKE2b."""
    import hashlib

    import numpy as np

    def one(words) -> int:
        words = [] if words is None else list(words)
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else words
        if not shingles:
            return 0
        raw = b"".join(hashlib.blake2b(s.encode(), digest_size=8).digest() for s in shingles)
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(len(shingles), 8), axis=1)
        return int(np.packbits(2 * bits.sum(axis=0, dtype=int) > len(shingles)).view(">i8")[0])

    return tokens.map(one)


def simhash(title: Column | str) -> Column:
    """64 bits as a signed long; 0 without words."""
    return _simhash(title_tokens(title))


def hamming(a: Column | str, b: Column | str) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.bit_count(a.bitwiseXOR(b))


def bucket(h: Column | str) -> Column:
    """The 16 high bits."""
    return F.shiftrightunsigned(h, 48)
