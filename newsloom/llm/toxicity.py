"""Toxicity by class-conditional Kneser-Ney language models."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tokens(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of lower-cased words (letters, digits, any non-ASCII characters), offsets by text."""
    import pyarrow.compute as pc

    from newsloom.llm import kernels as K

    return K.words(pc.utf8_lower(column), separators=K.NON_ALNUM, fold=K.FOLD)


@dataclass
class KneserNey:
    """Two interpolated bigram models over one vocabulary, as log-likelihood ratios.

    A class's bigram probability backs off to the class's own word
    probability, and that to how many different words precede the word in
    either class (shared). Only expressions that the classes use unequally by
    more than chance have probabilities of their own; all other words are one
    word, and all other pairs are left to the backoff: what a few texts say
    marks those texts and not their class.
    """

    words: np.ndarray = field(default=None)  # sorted hashes
    unigram: np.ndarray = field(default=None)  # log p(w | toxic) - log p(w | ordinary); last: any other word
    backoff: np.ndarray = field(default=None)  # log ratio of the backoff weights after a word
    pairs: np.ndarray = field(default=None)  # sorted keys of kept bigrams
    bigram: np.ndarray = field(default=None)
    slope: float = 1.0
    offset: float = 0.0

    TELLING = 12.0  # G statistic, 1 degree of freedom: p < 0.0006
    FOLDS = 3

    @staticmethod
    def _discount(counts: np.ndarray) -> float:
        one, two = int((counts == 1).sum()), int((counts == 2).sum())
        return min(0.95, max(0.5, one / (one + 2 * two))) if one else 0.75

    @classmethod
    def _telling(cls, keys: np.ndarray, text: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        """Sorted keys whose share of texts differs between the classes by more than chance (G test)."""
        order = np.lexsort((text, keys))
        k, t = keys[order], text[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1])
        found, place = np.unique(k[new], return_inverse=True)
        a = np.bincount(place, weights=toxic[t[new]] > 0, minlength=len(found))
        b = np.bincount(place, minlength=len(found)) - a
        big_a, big_b = max(1, (toxic > 0).sum()), max(1, (toxic <= 0).sum())
        p = (a + b) / (big_a + big_b)
        g = np.zeros(len(found))
        with np.errstate(divide="ignore", invalid="ignore"):
            for x, e in ((a, big_a * p), (big_a - a, big_a * (1 - p)), (b, big_b * p), (big_b - b, big_b * (1 - p))):
                g += np.where(x > 0, 2 * x * np.log(x / e), 0)
        return found[g >= cls.TELLING]

    @staticmethod
    def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Places of keys; len(sorted_keys) for those not there."""
        if not len(sorted_keys):
            return np.zeros(len(keys), np.int64)
        place = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
        return np.where(sorted_keys[place] == keys, place, len(sorted_keys))

    @classmethod
    def _fit(cls, hashes: np.ndarray, at: np.ndarray, toxic: np.ndarray) -> KneserNey:
        own = cls()
        size = np.diff(at)
        text, label = np.repeat(np.arange(len(size), dtype=np.int32), size), np.repeat(toxic > 0, size)
        own.words = cls._telling(hashes, text, toxic)
        v = len(own.words)
        ids = cls._find(own.words, hashes)
        here = np.flatnonzero(text[1:] == text[:-1]) + 1
        # shared: how many different words precede a telling word, in either class
        telling = np.flatnonzero(ids[here] < v)
        before, after_ = hashes[here[telling] - 1], ids[here[telling]]
        order = np.lexsort((after_, before))
        new = np.ones(len(order), bool)
        new[1:] = (before[order][1:] != before[order][:-1]) | (after_[order][1:] != after_[order][:-1])
        kinds = np.append(after_[order][new], np.full(len(np.unique(hashes[ids == v])), v))
        followed = np.bincount(kinds, minlength=v + 1)
        shared = (followed + 0.5) / (followed + 0.5).sum()
        key = ids[here - 1].astype(np.int64) * (v + 1) + ids[here]
        said = (ids[here - 1] < v) | (ids[here] < v)  # a pair of other words tells nothing
        own.pairs = cls._telling(key[said], text[here][said], toxic)
        place = cls._find(own.pairs, key)
        left, right = own.pairs // (v + 1), own.pairs % (v + 1)
        words, backs, pairs = [], [], []
        for side in (True, False):
            n = np.bincount(ids[label == side], minlength=v + 1)
            d = cls._discount(n[:-1])
            p = np.maximum(n - d, 0) / max(1, n.sum())
            words.append(p + (1 - p.sum()) * shared)
            mine = label[here] == side
            after = np.bincount(ids[here - 1][mine], minlength=v + 1)
            c = np.bincount(place[mine], minlength=len(own.pairs) + 1)[:-1]
            kept = np.maximum(c - cls._discount(c), 0)
            # a pull to the backoff after words that the class has seldom
            lam = 1 - np.bincount(left, weights=kept, minlength=v + 1) / (after + 5)
            backs.append(lam)
            pairs.append(kept / (after[left] + 5) + lam[left] * words[-1][right])
        own.unigram, own.backoff, own.bigram = (np.log(x[0] / x[1]) for x in (words, backs, pairs))
        return own

    @classmethod
    def fit(cls, texts, toxic: np.ndarray, share: float | None = None) -> KneserNey:
        """texts: Arrow strings; toxic: 0 or 1 by text; share: of toxic ones among all, if not as here."""
        return cls.fit_words(*tokens(texts), toxic, share)

    @classmethod
    def fit_words(cls, hashes: np.ndarray, at: np.ndarray, toxic: np.ndarray, share: float | None = None) -> KneserNey:
        """As fit, from word hashes and their offsets by text.

        The logistic scale is learned on ratios that models of the other folds
        give, since a model knows the texts it counted.
        """
        size, n = np.diff(at), len(toxic)
        out = np.zeros(n)
        fold = np.arange(n) % cls.FOLDS
        for k in range(cls.FOLDS):
            rest = np.flatnonzero(fold != k)
            if len(set(toxic[rest])) < 2:
                continue
            part = cls._fit(hashes[np.repeat(fold != k, size)], np.concatenate([[0], np.cumsum(size[rest])]), toxic[rest])
            out[fold == k] = part.means(hashes, at)[fold == k]
        own = cls._fit(hashes, at, toxic)
        own.slope, own.offset = cls._logistic(out, toxic)
        if share:
            here = toxic.mean()
            own.offset += float(np.log(share / (1 - share)) - np.log(here / (1 - here)))
        return own

    @staticmethod
    def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
        """Newton's method for P(y) = 1 / (1 + exp(-(a x + b))), with a weak pull to 0."""
        scale = x.std() or 1.0
        z = np.stack([x / scale, np.ones_like(x)], axis=1)
        w = np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            h = (z * (p * (1 - p))[:, None]).T @ z + np.diag([1e-3, 1e-6])
            step = np.linalg.solve(h, z.T @ (y - p) - np.array([1e-3, 1e-6]) * w)
            w += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-9:
                break
        return float(w[0] / scale), float(w[1])

    def means(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Mean log-likelihood ratio of each text's words; 0 without words."""
        n, v = np.diff(at), len(self.words)
        if not len(hashes):
            return np.zeros(len(n))
        ids = self._find(self.words, hashes)
        ratio = self.unigram[ids].astype(np.float64)
        first = np.zeros(len(hashes), bool)
        first[at[:-1][at[:-1] < len(hashes)]] = True
        here = np.flatnonzero(~first)
        before = ids[here - 1]
        ratio[here] += self.backoff[before]
        if len(self.pairs):
            place = self._find(self.pairs, before.astype(np.int64) * (v + 1) + ids[here])
            seen = place < len(self.pairs)
            ratio[here[seen]] = self.bigram[place[seen]]
        total = np.concatenate([[0.0], np.cumsum(ratio)])
        return (total[at[1:]] - total[at[:-1]]) / np.maximum(n, 1)

    def scores(self, texts) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.means(*tokens(texts)) + self.offset, -30, 30)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 2500, class_bytes: int = 64_000_000) -> KneserNey:
    """A model of labelled rows, of which it takes ``per_class`` ids of each class at most, and ``class_bytes`` of their texts.

    The bounds hold what the driver collects; the rows are those of smallest
    id hash, so the sample is the same every time. A text that would pass the
    second bound is left out whole; a class of which none fits gives its shortest. Rows with null ids, labels
    or texts are left out; an id labelled both ways counts as toxic. Without rows
    of both classes the model is neutral.
    """
    spark = docs.sparkSession
    known = labels.select(labels[id_col].alias("_id"), labels[label_col].cast("int").alias("_toxic")).where("_id IS NOT NULL AND _toxic IN (0, 1)")
    known = known.groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    sizes = {r["_toxic"]: r["count"] for r in known.groupBy("_toxic").count().collect()}
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("_toxic") == y).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("_text")).where("_text IS NOT NULL")
    kind = dict(texts.dtypes)["_id"]

    def hashed(batches):
        import pyarrow as pa

        from newsloom.llm import kernels as K

        for batch in batches:
            for part in K.slices(batch, "_text"):
                found, at = tokens(part.column("_text"))
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_toxic"), K.list_column(K.signed(found), at, pa.int64())], names=["_id", "_toxic", "words"])

    found = texts.join(F.broadcast(chosen), "_id")  # bounded by per_class
    each = found.groupBy("_id", "_toxic").agg(F.sum(F.octet_length("_text")).alias("n")).withColumn("_h", F.xxhash64("_id")).collect()
    taken = []
    for y in (0, 1):
        own, left, at = sorted((r for r in each if r["_toxic"] == y), key=lambda r: (r["_h"], r["_id"])), class_bytes, len(taken)
        for r in own:
            if r["n"] <= left:
                left -= r["n"]
                taken.append((r["_id"],))
        if own and len(taken) == at:
            taken.append((min(own, key=lambda r: r["n"])["_id"],))
    if len(taken) < len(each):
        found = found.join(F.broadcast(spark.createDataFrame(taken, f"_id {kind}")), "_id", "left_semi")
    # texts are cut into words where they are
    rows = found.select("_id", "_toxic", "_text").mapInArrow(hashed, f"_id {kind}, _toxic int, words array<long>").toArrow()
    toxic = rows.column("_toxic").to_numpy().astype(np.float64)
    if not len(toxic) or toxic.min() == toxic.max():
        return KneserNey(*(np.zeros(k, t) for k, t in ((0, np.uint64), (1, float), (1, float), (0, np.int64), (0, float))), offset=-1.0)
    order = np.argsort(rows.column("_id").to_numpy(), kind="stable")
    lists = rows.column("words").combine_chunks()
    del rows
    at, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
    size = np.diff(at)[order]
    starts = at[:-1][order]
    to = np.concatenate([[0], np.cumsum(size)])
    words = flat[np.repeat(starts - to[:-1], size) + np.arange(to[-1])]
    return KneserNey.fit_words(words, to, toxic[order], sizes[1] / (sizes[0] + sizes[1]))


def toxicity(docs: DataFrame, model: KneserNey, id_col: str = "doc_id", text_col: str = "text", carry: bool = False, score_col: str = "score", predicted_col: str = "predicted") -> DataFrame:
    """score (0 to 1) and predicted (1 if score >= 0.5) of every row, beside its id or (carry) all its columns.

    The score is a logistic function of the mean ratio of toxic and ordinary
    log-likelihoods by word. Null texts score as empty ones: as the offset
    alone has it. Whole texts of any length; nothing but the text is read.
    Carried columns of the names of score_col or predicted_col are replaced.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)  # bounded by fit_toxicity's per_class
    rows = docs.drop(score_col, predicted_col) if carry else docs.select(id_col, text_col)
    back = [f for f in rows.schema if carry or f.name == id_col]
    names = [f.name for f in back]

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        from newsloom.llm import kernels as K

        for batch in batches:
            for part in K.slices(batch, text_col):
                score = held.value.scores(pc.fill_null(part.column(text_col), ""))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))], names=[*names, score_col, predicted_col])

    return rows.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in back), f"{score_col} double", f"{predicted_col} int"]))


def held_out(column) -> F.Column:
    """Whether a row is kept from learning: crc32 of its id as text divides by 5."""
    return F.crc32(column.cast("string").cast("binary")) % 5 == 0
