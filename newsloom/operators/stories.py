"""Stories: re-publications grouped by rarity-weighted title similarity in a time window."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.text import title_tokens
from newsloom.operators.tables import Scratch, connected_components

THRESHOLD, LEAST_COMMON, HOURS = 0.30, 3, 72
#: Parts that a word's sets are dealt to, and rows of a set that are spelled out together: sizes of work, not limits.
PARTS, ROWS = 16, 4096


def document_frequency(items: DataFrame, title: str = "title") -> DataFrame:
    """(word, df, idf) over distinct title words; idf = ln(1 + N / df)."""
    words = items.select(F.explode(F.array_distinct(title_tokens(title))).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    total = items.agg(F.greatest(F.count("*"), F.lit(1)).alias("n"))
    return words.crossJoin(F.broadcast(total)).select("word", "df", F.log(1 + F.col("n") / F.col("df")).alias("idf"))


def weighted_tokens(items: DataFrame, id_col: str = "id", title: str = "title", published: str = "published") -> DataFrame:
    """(id, published, words array<struct<idf, word>> rarest first, weight): titles without words are left out."""
    idf = document_frequency(items, title)
    words = items.select(F.col(id_col).alias("id"), F.col(published).alias("published"), F.explode(F.array_distinct(title_tokens(title))).alias("word"))
    joined = words.join(idf, "word").groupBy("id", "published").agg(F.sort_array(F.collect_list(F.struct("idf", "word")), asc=False).alias("words"))
    return joined.withColumn("weight", F.aggregate("words", F.lit(0.0), lambda a, x: a + x["idf"]))


def _slot(at: str, hours: int) -> Column:
    return F.floor(F.unix_micros(at) / F.lit(hours * 3_600_000_000))


def _indexed(threshold: float, least: int) -> Column:
    """Of ``words`` (rarest first, with weights) those to index: see similar_pairs."""
    # keep a word while enough weight and enough words follow from it on
    rest = lambda i: F.aggregate(F.slice("words", i + 1, F.size("words")), F.lit(0.0), lambda a, y: a + y["idf"])
    told = F.transform(F.col("words"), lambda x, i: F.struct(x["word"].alias("word"), ((rest(i) >= threshold * F.col("weight") * (1 - 1e-9)) & (F.size("words") - i >= least)).alias("kept")))
    return F.transform(F.filter(told, lambda x: x["kept"]), lambda x: x["word"])


def _candidates(t: DataFrame, threshold: float, hours: int, least: int) -> DataFrame:
    """Distinct (a, b), a < b, of dated rows (id, low, high, words, weight) that share an indexed word.

    low and high bound the times a row stands for, all within one slot of
    ``hours``; rows meet if they come as near as that.
    """
    ordered = (F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b"))
    dated = t.where("low IS NOT NULL").select("id", "low", "high", F.explode(_indexed(threshold, least)).alias("k")).withColumn("s", _slot("low", hours))
    near = dated.withColumn("at", F.explode(F.array(F.col("s"), F.col("s") - 1)))  # a row also meets those of the slot before
    l, r = dated.alias("l"), near.alias("r")
    close = F.unix_micros("r.low") - F.unix_micros("l.high") <= hours * 3_600_000_000
    once = F.when(F.col("l.s") == F.col("r.s"), F.col("l.id") < F.col("r.id")).otherwise(close & (F.col("l.id") != F.col("r.id")))
    return l.join(r, (F.col("l.k") == F.col("r.k")) & (F.col("l.s") == F.col("r.at")) & once).select(*ordered).distinct()


def _set_pairs(sets: DataFrame, threshold: float, least: int) -> DataFrame:
    """(a, na, b, nb, similarity) of similar word sets (set, words, weight, undated, many), a being one of undated rows.

    Pairs of two such sets come in both orders, those of a set with itself not
    at all. na: undated rows of a, nb: all rows of b. A pair counts where its
    rarest common word is the key, so none comes twice and nothing is gathered
    to tell them apart; a word's sets are dealt to PARTS parts.
    """
    flat = sets.select("set", "words", "weight", "undated", "many", F.explode(_indexed(threshold, least)).alias("k"))
    l = flat.withColumn("part", F.pmod(F.xxhash64("set"), F.lit(PARTS)).cast("int")).alias("l")
    r = flat.where("undated > 0").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))).alias("r")
    common = F.array_intersect("l.words.word", "r.words.word")
    told = (F.col("l.set") != F.col("r.set")) & (F.size(common) >= least) & (F.get(common, F.lit(0)) == F.col("r.k"))
    met = l.join(r, (F.col("l.k") == F.col("r.k")) & (F.col("l.part") == F.col("r.part")) & told)
    shared = F.aggregate(F.array_intersect("l.words", "r.words"), F.lit(0.0), lambda a, w: a + w["idf"])
    pairs = met.select(F.col("r.set").alias("a"), F.col("r.undated").alias("na"), F.col("l.set").alias("b"), F.col("l.many").alias("nb"), (F.col("l.weight") + F.col("r.weight")).alias("_both"), shared.alias("_shared"))
    return pairs.select("a", "na", "b", "nb", (F.col("_shared") / (F.col("_both") - F.col("_shared"))).alias("similarity")).where(F.col("similarity") >= threshold)


def _spanning(links: np.ndarray) -> np.ndarray:
    """Links (n x 2) that join the same nodes, one less than nodes in each component."""
    nodes, at = np.unique(links, return_inverse=True)
    a, b = at.reshape(-1, 2).T
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        if not (apart := x != y).any():
            break
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (label != (up := label[label])).any():
            label = up
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return np.stack([nodes[own], nodes[label[own]]], axis=1)


def _forest(links: DataFrame) -> DataFrame:
    """Links (a, b), each partition's thinned to a forest: as many as it has nodes at most."""

    def run(frames):
        held, waiting, n = None, [], 0
        for f in frames:
            waiting.append(f.to_numpy())
            n += len(f)
            if n >= max(1 << 20, 2 * len(held) if held is not None else 0):
                held, waiting, n = _spanning(np.concatenate([*([] if held is None else [held]), *waiting])), [], 0
        if held is not None or waiting:
            held = _spanning(np.concatenate([*([] if held is None else [held]), *waiting]))
            for i in range(0, len(held), 100_000):
                yield pd.DataFrame(held[i : i + 100_000], columns=["a", "b"])

    return links.select("a", "b").mapInPandas(run, links.select("a", "b").schema)


def _scored(candidates: DataFrame, t: DataFrame, threshold: float, least: int) -> DataFrame:
    """(a, b, similarity) of candidates at or above the threshold."""
    of = lambda side: t.select(F.col("id").alias(side), F.col("words").alias(f"w{side}"), F.col("weight").alias(f"n{side}"))
    both = candidates.join(of("a"), "a").join(of("b"), "b")
    common = F.array_intersect("wa", "wb")
    shared = F.aggregate(common, F.lit(0.0), lambda a, w: a + w["idf"])
    scored = both.where(F.size(common) >= least).select("a", "b", (shared / (F.col("na") + F.col("nb") - shared)).alias("similarity"))
    return scored.where(F.col("similarity") >= threshold)


def similar_pairs(items: DataFrame, id_col: str = "id", title: str = "title", published: str = "published", threshold: float = THRESHOLD, hours: int | None = HOURS, least: int = LEAST_COMMON) -> DataFrame:
    """(a, b, similarity), a < b, of titles at or above the threshold, within the window: each pair.

    An equi-join on words. Of a title only its rarest words are indexed: two
    of its commonest are left out (a pair shares three words or more), and so
    is a tail lighter than threshold times the title's weight (the shared
    weight is at least that). Both rules lose no pair and keep frequent words
    out of the join. Dated titles meet by windows of ``hours``. Undated ones
    (all, if hours is None) are compared with all, once for all titles of the
    same words; only what is similar is then spelled out by rows, ROWS of a
    title at a time. ``stories`` needs no pairs of equal titles.
    """
    scratch = Scratch(items.sparkSession, "pairs")
    t = scratch.write(weighted_tokens(items, id_col, title, published).withColumns({"low": F.col("published"), "high": F.col("published")}), "words")
    loose = F.lit(True) if hours is None else F.col("published").isNull()
    near = None if hours is None else _scored(_candidates(t, threshold, hours, least), t, threshold, least)
    if t.where(loose).isEmpty():
        return t.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("similarity")).limit(0) if near is None else near
    rows = t.withColumn("same", F.array_join("words.word", " ")).withColumn("loose", loose)
    sets = rows.groupBy("same").agg(F.min("id").alias("set"), F.count_if("loose").alias("undated"), F.count("*").alias("many"), F.first("words").alias("words"), F.first("weight").alias("weight"))
    sets = scratch.write(sets, "sets")
    equal = sets.where((F.col("undated") > 0) & (F.size("words") >= least)).select(F.col("set").alias("a"), F.col("undated").alias("na"), F.col("set").alias("b"), F.col("many").alias("nb"), F.lit(1.0).alias("similarity"))
    pairs = scratch.write(_set_pairs(sets, threshold, least).unionByName(equal), "pairs")
    chunks = lambda n: F.ceil(F.col(n) / ROWS).cast("long")
    chunk = lambda n: F.pmod(F.xxhash64("id"), chunks(n))
    held = scratch.write(rows.select("id", "same", "loose").join(sets.select("same", "set", "undated", "many"), "same").select("id", "set", "loose", "undated", "many"), "rows")
    each = pairs.withColumn("ca", F.explode(F.sequence(F.lit(0), chunks("na") - 1))).withColumn("cb", F.explode(F.sequence(F.lit(0), chunks("nb") - 1)))
    x = held.where("loose").select(F.col("set").alias("a"), chunk("undated").alias("ca"), F.col("id").alias("x"))
    y = held.select(F.col("set").alias("b"), chunk("many").alias("cb"), F.col("id").alias("y"), "loose")
    met = each.join(x, ["a", "ca"]).join(y, ["b", "cb"]).where("x < y OR (NOT loose AND x <> y)")  # of two undated rows one order counts
    found = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "similarity")
    return found if near is None else found.unionByName(near)


def stories(items: DataFrame, id_col: str = "id", title: str = "title", published: str = "published", threshold: float = THRESHOLD, hours: int = HOURS, least: int = LEAST_COMMON) -> DataFrame:
    """(id, story_id): the transitive closure of similar pairs; story_id: its smallest id.

    Titles of the same words in the same slot of ``hours`` are similar and near
    each other, so they are one class, known by its smallest id, first and last
    time; members hang on it by one link each. Only classes are compared: in
    one slot all are near, in neighbouring slots if the later one's first time
    is near the earlier one's last. So a story of n re-publications costs n
    links and not their pairs. Undated titles meet all, so they are compared
    by word sets: what one of them is similar to is one story whenever it was
    published, and such a set's classes hang on one by a link each. Titles of
    fewer words than ``least`` stay alone.
    """
    scratch = Scratch(items.sparkSession, "stories")
    words = F.array_sort(F.array_distinct(title_tokens(title)))
    rows = items.select(F.col(id_col).alias("id"), F.col(published).alias("published"), F.array_join(words, " ").alias("same"), F.size(words).alias("n")).where(F.col("n") >= least)
    rows = scratch.write(rows.select("id", "published", "same", _slot("published", hours).alias("slot")), "titles")
    classes = scratch.write(rows.groupBy("same", "slot").agg(F.min("id").alias("id"), F.min("published").alias("low"), F.max("published").alias("high")), "classes")
    idf = document_frequency(items, title)
    sets = classes.groupBy("same").agg(F.min("id").alias("set"), F.count_if(F.col("slot").isNull()).alias("undated"), F.count("*").alias("many"))
    each = sets.withColumn("word", F.explode(F.split("same", " "))).join(idf, "word")
    sets = each.groupBy("same", "set", "undated", "many").agg(F.sort_array(F.collect_list(F.struct("idf", "word")), asc=False).alias("words"))
    sets = scratch.write(sets.withColumn("weight", F.aggregate("words", F.lit(0.0), lambda a, x: a + x["idf"])), "sets")
    t = scratch.write(classes.where("slot IS NOT NULL").join(sets.select("same", "words", "weight"), "same").select("id", "low", "high", "words", "weight"), "words")
    links = _scored(_candidates(t, threshold, hours, least), t, threshold, least).select("a", "b")
    if not (loose := sets.where("undated > 0").select("set")).isEmpty():
        pairs = scratch.write(_forest(_set_pairs(sets, threshold, least)), "pairs")
        met = pairs.select(F.explode(F.array("a", "b")).alias("set")).unionByName(loose).distinct()
        hung = classes.join(sets.select("same", "set").join(met, "set"), "same").select(F.col("id").alias("a"), F.col("set").alias("b"))
        links = links.unionByName(pairs).unionByName(hung.where("a <> b"))
    c, r = classes.select(F.col("id").alias("b"), "same", "slot").alias("c"), rows.alias("r")
    member = r.join(c, (F.col("r.same") == F.col("c.same")) & F.col("r.slot").eqNullSafe(F.col("c.slot"))).select(F.col("r.id").alias("a"), "b")
    links = scratch.write(links.unionByName(member.where("a <> b")), "links")
    parts = scratch.write(connected_components(scratch, links), "components")
    scratch.drop(rows, classes, sets, t, links)
    return items.select(F.col(id_col).alias("id")).join(parts, F.col("id") == F.col("node"), "left").select("id", F.coalesce("component", "id").alias("story_id"))


def rollup(items: DataFrame, membership: DataFrame) -> DataFrame:
    """Of each story: size, first and last publication, and the title of its earliest mention."""
    joined = membership.join(items.select("id", "title", "published"), "id")
    order = F.struct(F.col("published").isNull(), "published", "id")
    return joined.groupBy("story_id").agg(F.count("*").alias("n_mentions"), F.min("published").alias("first_pub"), F.max("published").alias("last_pub"), F.min_by("title", order).alias("canonical_title"))


def band_join(new: DataFrame, stored: DataFrame, hours: int = HOURS, at: str = "published") -> DataFrame:
    """Pairs (new_id, stored_id) of rows within ``hours`` of one another, by an equi-join on windows."""
    n = new.where(F.col(at).isNotNull()).select(F.col("id").alias("new_id"), F.col(at).alias("_n"), F.explode(F.sequence(_slot(at, hours) - 1, _slot(at, hours) + 1)).alias("_s"))
    s = stored.where(F.col(at).isNotNull()).select(F.col("id").alias("stored_id"), F.col(at).alias("_o"), _slot(at, hours).alias("_s"))
    return n.join(s, "_s").where(F.abs(F.unix_micros("_n") - F.unix_micros("_o")) <= hours * 3_600_000_000).select("new_id", "stored_id")


def assign_online(new: DataFrame, stored: DataFrame, hours: int = HOURS, threshold: float = THRESHOLD, least: int = LEAST_COMMON) -> DataFrame:
    """(id, story_id) of new rows: of the stored row most similar by plain word sets, or their own id.

    stored: id, title, published, story_id. Undated rows begin a story. Ties
    go to the smaller stored id. Candidates are not capped: they share a word
    that both index. Each title indexes its rarest words (by how many stored
    titles have them) and leaves out so many of its commonest that a similar
    pair cannot be made of those alone. Only ids meet in the join; the words
    follow for the pairs that come out of it.
    """
    words = F.array_distinct(title_tokens("title"))
    n = new.where("published IS NOT NULL").select("id", "published", words.alias("w"))
    s = stored.where("published IS NOT NULL AND story_id IS NOT NULL").select("id", "published", "story_id", words.alias("w"))
    df = s.select(F.explode("w").alias("word")).groupBy("word").agg(F.count("*").alias("df"))

    def keys(rows: DataFrame) -> DataFrame:
        each = rows.where(F.size("w") >= least).select("id", "published", F.size("w").alias("n"), F.explode("w").alias("word")).join(df, "word", "left")
        # a similar title shares max(least, threshold * n) words with it
        held = each.groupBy("id", "published", "n").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "word"))).alias("words"))
        needed = F.greatest(F.lit(least), F.ceil(threshold * F.col("n") - 1e-9).cast("int"))
        return held.select("id", "published", F.explode(F.slice("words", F.lit(1), F.col("n") - needed + 1)).alias("k")).select("id", "published", "k.word")

    l = keys(n).withColumn("at", F.explode(F.array(*(_slot("published", hours) + d for d in (-1, 0, 1))))).alias("l")
    r = keys(s).withColumn("at", _slot("published", hours)).alias("r")
    close = F.abs(F.unix_micros("l.published") - F.unix_micros("r.published")) <= hours * 3_600_000_000
    near = l.join(r, (F.col("l.word") == F.col("r.word")) & (F.col("l.at") == F.col("r.at")) & close).select(F.col("l.id").alias("id"), F.col("r.id").alias("sid")).distinct()
    both = near.join(n.select("id", F.col("w").alias("wn")), "id").join(s.select(F.col("id").alias("sid"), "story_id", F.col("w").alias("ws")), "sid")
    common = F.size(F.array_intersect("wn", "ws"))
    scored = both.where(common >= least).withColumn("sim", common / F.size(F.array_union("wn", "ws"))).where(F.col("sim") >= threshold)
    best = scored.groupBy("id").agg(F.max_by("story_id", F.struct("sim", -F.col("sid"))).alias("story_id"))
    return new.select("id").join(best, "id", "left").select("id", F.coalesce("story_id", "id").alias("story_id"))


def latest_per(rows: DataFrame, key: str, order: list) -> DataFrame:
    """The last row of each key; an aggregate, so combined before the shuffle."""
    rest = [c for c in rows.columns if c != key]
    last = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return last.select(key, *(F.col(f"_row.`{c}`").alias(c) for c in rest))


def rank_by(partition: list[str], order: list) -> Column:
    return F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
