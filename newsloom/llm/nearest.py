"""Approximate nearest neighbours by collision counting over single projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(_id, v array<double>) of rows whose vector is of the usual length, finite and not zero."""
    rows = vectors.select(vectors[id_col].cast("long").alias("_id"), vectors[vector_col].cast("array<double>").alias("v"))
    good = rows.where("_id IS NOT NULL AND v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)")
    usual = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return good.where(F.size("v") == (usual["n"] if usual else 0))


class Index:
    """Sorted single projections of one block of vectors.

    Inner product becomes Euclidean nearness by one more coordinate,
    sqrt(M^2 - |v|^2) with M the largest norm, and 0 for a query scaled to M.
    """

    def __init__(self, ids, vectors, largest: float, projections: int, seed: int = 7):
        import numpy as np

        self.ids, self.vectors, self.largest = ids, vectors, largest
        rest = np.sqrt(np.maximum(largest**2 - (vectors**2).sum(axis=1), 0))
        lift = np.concatenate([vectors, rest[:, None]], axis=1) / largest
        lines = np.random.default_rng(seed).standard_normal((lift.shape[1], projections))
        self.lines, at = lines, (lift @ lines).T
        self.order = np.argsort(at, axis=1, kind="stable")
        self.sorted = np.take_along_axis(at, self.order, axis=1)

    def windows(self, queries, half: float):
        """Of each line (rows) and query (columns), the window's first place and the one after its last."""
        import numpy as np

        scaled = queries / np.sqrt((queries**2).sum(axis=1))[:, None]
        center = (scaled @ self.lines[:-1]).T
        low = np.array([np.searchsorted(s, c - half, "left") for s, c in zip(self.sorted, center, strict=True)])
        high = np.array([np.searchsorted(s, c + half, "right") for s, c in zip(self.sorted, center, strict=True)])
        return low, high

    def candidates(self, queries, enough: int, threshold: float, first: float, growth: float):
        """Yields each query's candidates: places of the vectors whose collisions exceed the threshold.

        A vector collides on a line if it lies in the query-centred window.
        Windows start ``first`` wide to each side and grow by ``growth``
        (virtual rehashing) until ``enough`` vectors collide on the share
        ``threshold`` of lines. Windows hold most of a line, so what is counted
        is who lies outside; growing takes back the places passed.
        """
        import numpy as np

        n, m = len(self.ids), len(self.sorted)
        allowed = int((1 - threshold) * m)
        rounds = [self.windows(queries, first)]
        for k in range(len(queries)):
            low, high = (x[:, k].tolist() for x in rounds[0])
            parts = [x for o, i, j in zip(self.order, low, high, strict=True) for x in (o[:i], o[j:])]
            outside = np.bincount(np.concatenate(parts), minlength=n)
            step = 0
            while (outside <= allowed).sum() < min(enough, n) and (max(low) > 0 or min(high) < n):
                step += 1
                if step == len(rounds):
                    rounds.append(self.windows(queries, first * growth**step))
                a, b = (x[:, k].tolist() for x in rounds[step])
                parts = [x for o, i, j, p, q in zip(self.order, a, b, low, high, strict=True) for x in (o[i:p], o[q:j])]
                outside -= np.bincount(np.concatenate(parts), minlength=n)
                low, high = a, b
            yield np.flatnonzero(outside <= allowed)


def nearest(vectors: DataFrame, queries: DataFrame | None = None, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, every: int = 20, projections: int = 96, share: float = 0.1, least: int = 400, threshold: float = 0.86, first: float = 1.6, growth: float = 1.06, rows_per_block: int = 16384, queries_per_block: int = 4096) -> DataFrame:
    """The k vectors of largest inner product found for each query: query_id, rank, vec_id, score.

    Queries are rows whose id divides by ``every`` (or the rows of
    ``queries``); candidates are all rows but the query's own. Rows are dealt
    by id hash into blocks; each block builds its sorted lines once and
    searches them for a block of queries at a time, so neither side is ever
    held whole. In each block windows grow until ``share`` of its rows (and
    ``least``) collide on ``threshold`` of the lines; these alone are verified by
    their inner product in double precision. The best k of all blocks follow.

    Vectors null, of an unusual length, zero or with null or non-finite parts
    take no part; null ids neither. Repeated ids count once each row. Fewer
    candidates than k give as many rows. Ties go to the smaller id.
    """
    import numpy as np

    spark = vectors.sparkSession
    good = usable(vectors, id_col, vector_col)
    ask = (usable(queries, id_col, vector_col) if queries is not None else good.where(F.pmod("_id", F.lit(every)) == 0))
    facts = good.agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).alias("m")).first()
    n, largest = facts["n"], facts["m"] or 1.0
    asked = ask.count()
    blocks, groups = -(-n // rows_per_block) or 1, -(-asked // queries_per_block) or 1
    rows = good.select(F.pmod(F.xxhash64("_id"), F.lit(blocks)).alias("b"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(False).alias("q"), "_id", "v")
    asks = ask.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(groups)).alias("g"), F.lit(True).alias("q"), "_id", "v")

    def search(table):
        import pyarrow as pa

        table = table.combine_chunks()
        is_query = table.column("q").to_numpy(zero_copy_only=False)
        ids = table.column("_id").to_numpy()
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        out = ([], [], [])
        own_ids, own = ids[~is_query], flat[~is_query]
        order = np.argsort(own_ids, kind="stable")
        own_ids, own = own_ids[order], own[order]
        if len(own_ids) and is_query.any():
            index = Index(own_ids, own, largest, projections)
            enough = max(k + 1, least, int(share * len(own_ids)))
            asked = np.flatnonzero(is_query)
            runs = (asked[a : a + 256] for a in range(0, len(asked), 256))
            for i, found in ((i, f) for run in runs for i, f in zip(run, index.candidates(flat[run], enough, threshold, first, growth), strict=True)):
                found = found[own_ids[found] != ids[i]]
                score = np.einsum("ij,j->i", own[found], flat[i])
                best = np.lexsort((own_ids[found], -score))[:k]
                out[0].append(np.full(len(best), ids[i]))
                out[1].append(own_ids[found][best])
                out[2].append(score[best])
        cat = [np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(out, (np.int64, np.int64, float), strict=True)]
        return pa.table({"query_id": pa.array(cat[0], pa.int64()), "vec_id": pa.array(cat[1], pa.int64()), "score": pa.array(cat[2], pa.float64())})

    found = rows.unionByName(asks).groupBy("b", "g").applyInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
