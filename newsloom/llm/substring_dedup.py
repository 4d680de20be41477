"""Repeated word windows across documents, by levels of doubled length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.scratch import Scratch


def levels(window: int, least: int = 10) -> list[int]:
    """The lengths from which windows are doubled up to ``window``: halves of it down to ``least`` words."""
    out = [window // 2]
    while out[0] % 2 == 0 and out[0] // 2 >= least:
        out.insert(0, out[0] // 2)
    return out


def anchors_of(hashes, at, half: int, alive=None):
    """(windows, anchors, n-grams): starts of windows of 2 * half words within one text, and each one's anchor.

    A window's anchor is the start of its smallest n-gram of ``half`` words,
    the first of equals. It depends on the window's words alone, so equal
    windows have equal n-grams at equal places as anchors. alive: of each
    place, whether the window of ``half`` words from there has survived the
    level before; only windows of which both halves have are given.
    """
    import numpy as np

    from newsloom.llm import kernels as K

    grams = K.ngrams(hashes, half)
    n = len(grams) - half
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), grams
    best, where = grams[:n].copy(), np.arange(n)
    for k in range(1, half + 1):
        other = grams[k : k + n]
        less = other < best
        best[less] = other[less]
        where[less] = np.flatnonzero(less) + k
    ends = np.repeat(at[1:], np.diff(at))
    good = np.arange(n) + 2 * half <= ends[:n]
    if alive is not None:
        good &= alive[:n] & alive[half : half + n]
    ok = np.flatnonzero(good)
    return ok, where[ok], grams


def marked(lists, at, n: int):
    """Of each of n places, whether its text's list (null: none) has it."""
    import numpy as np
    import pyarrow.compute as pc

    out = np.zeros(n + 1, bool)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    out[np.repeat(at[:-1], sizes) + lists.flatten().to_numpy(zero_copy_only=False)] = True
    return out


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("long").alias("_id"), docs[text_col].cast("string").alias("_text"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """Per row: id, n_words, n_removed, kept_sha256 and kept (the text left).

    Words are runs without ASCII white space, unchanged. Each word covered by
    a window of ``window`` words (an even number) is removed if the window's
    words also start earlier: in a smaller id, or earlier in the same text.

    Levels double the length: 10 to 20, for longer windows on to 40, 80 and so
    on (see ``levels``). A level begins with windows of which both halves have
    survived the one before, counts of each its anchor n-gram of half the
    length over all texts (about a sixth of all places at first), and drops
    those whose anchor occurs once, since they cannot repeat. It stops where no
    window survives, or at ``window``: there the first place of each is found.
    Windows of greater lengths are covered by these and would remove no more.
    Counts and first places are partially aggregated: a passage of very many
    documents is reduced before the shuffle, and no group is gathered. Only
    places that occur once, or are the first, travel back to their documents.

    Null text: none. Null ids: no window of theirs counts or is removed. Rows
    that share an id are one document, held to have one text. Empty tables
    give empty tables; other columns are ignored. Window hashes have 96 bits.
    Texts are shuffled as zstd frames; a text of any length is handled whole,
    by one task.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    halves = levels(window)

    def anchors(half: int, first: bool):
        def run(batches):
            import numpy as np
            import pyarrow as pa

            from newsloom.llm import kernels as K

            for batch in batches:
                for part in K.slices(batch, "_text"):
                    hashes, at = K.words(part.column("_text") if first else K.unsqueeze(part.column("_text")))
                    _, where, grams = anchors_of(hashes, at, half, None if first else marked(part.column("alive"), at, len(hashes)))
                    where = np.unique(where)
                    row = np.searchsorted(at, where, "right") - 1
                    yield pa.RecordBatch.from_arrays([pa.array(K.signed(grams[where]), pa.int64()), part.column("_id").take(pa.array(row)), pa.array((where - at[row]).astype(np.int32))], names=["gram", "_id", "place"])

        return run

    def squeezed(batches):
        import pyarrow as pa

        from newsloom.llm import kernels as K

        for batch in batches:
            for part in K.slices(batch, "_text", 8_000_000):
                yield pa.RecordBatch.from_arrays([part.column("_id"), K.squeeze(part.column("_text"))], names=["_id", "_text"])

    def survivors(half: int, first: bool):
        """Of each text, the starts of windows whose anchor is repeated, with what the text has."""
        import numpy as np
        import pyarrow.compute as pc

        from newsloom.llm import kernels as K

        def of(part):
            column = K.unsqueeze(part.column("_text"))
            hashes, at = K.words(column)
            start, anchor, _ = anchors_of(hashes, at, half, None if first else marked(part.column("alive"), at, len(hashes)))
            row = np.searchsorted(at, start, "right") - 1
            known = ~pc.is_null(part.column("_id")).to_numpy(zero_copy_only=False)
            go = ~marked(part.column("single"), at, len(hashes))[anchor] & known[row]
            return column, hashes, at, start[go], row[go]

        return of

    def narrowed(half: int, first: bool):
        def run(batches):
            import numpy as np
            import pyarrow as pa

            from newsloom.llm import kernels as K

            for batch in batches:
                for part in K.slices(batch, "_text", 600_000):
                    _, _, at, start, row = survivors(half, first)(part)
                    by = np.searchsorted(row, np.arange(part.num_rows + 1))
                    yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_text"), K.list_column((start - at[row]).astype(np.int32), by, pa.int32())], names=["_id", "_text", "alive"])

        return run

    def repeated(state: DataFrame, source: DataFrame, half: int, first: bool) -> DataFrame:
        """state with ``single``: the places of anchors that occur once."""
        once = source.where("_id IS NOT NULL").mapInArrow(anchors(half, first), "gram long, _id long, place int")
        once = once.groupBy("gram").agg(F.count("*").alias("n"), F.min("_id").alias("_id"), F.min("place").alias("place")).where("n = 1")
        return state.join(once.groupBy("_id").agg(F.collect_list("place").alias("single")), "_id", "left")

    rows = _rows(docs, id_col, text_col)
    state, source, first = rows.mapInArrow(squeezed, "_id long, _text binary"), rows, True
    for half in halves[:-1]:
        before = state
        state = scratch.write(repeated(state, source, half, first).mapInArrow(narrowed(half, first), "_id long, _text binary, alive array<int>"), f"level-{2 * half}")
        if not first:
            scratch.drop(before)
        source, first = state, False
        if state.where("size(alive) > 0").isEmpty():
            break  # nothing repeats at this length; the last level then finds no window to look at
    half = halves[-1]
    joined = repeated(state, source, half, first)

    def windows(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        from newsloom.llm import kernels as K

        for batch in batches:
            for part in K.slices(batch, "_text", 600_000):
                n = part.num_rows
                column, hashes, at, start, row = survivors(half, first)(part)
                h1, h2 = (K.doubled(K.ngrams(hashes, half, s), half) for s in (1, 2))
                by = np.searchsorted(row, np.arange(n + 1))
                place = (start - at[row]).astype(np.int32)
                # a document's own first place of each window goes on
                order = np.lexsort((start, h2[start], h1[start], row))
                a, b, c = h1[start][order], h2[start][order], row[order]
                new = np.ones(len(order), bool)
                new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])
                lead = order[new]
                lead_by = np.searchsorted(row[lead], np.arange(n + 1))
                texts = column.to_pylist()
                has = np.diff(by) > 0
                sha = [None if has[i] else hashlib.sha256(b" ".join(texts[i].encode().split())).hexdigest() for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(np.diff(at), pa.int64()), pa.array(sha, pa.string()), pa.array([t if h else None for h, t in zip(has.tolist(), part.column("_text").to_pylist(), strict=True)], pa.binary()), K.list_column(place, by, pa.int32()), *(K.list_column(x[lead], lead_by, kind) for x, kind in ((K.signed(h1[start]), pa.int64()), (h2[start].astype(np.uint32).view(np.int32), pa.int32()), (place, pa.int32())))],
                    names=["_id", "n_words", "sha", "_text", "place", "h1", "h2", "lead"],
                )

    level = scratch.write(joined.mapInArrow(windows, "_id long, n_words long, sha string, _text binary, place array<int>, h1 array<long>, h2 array<int>, lead array<int>"), "windows")
    if not first:
        scratch.drop(state)
    flat = level.where("sha IS NULL").select("_id", F.explode(F.arrays_zip("h1", "h2", "lead")).alias("w")).select("_id", "w.h1", "w.h2", "w.lead")
    first = flat.groupBy("h1", "h2").agg(F.min("_id").alias("_first"), F.min_by("lead", "_id").alias("lead")).groupBy(F.col("_first").alias("_id")).agg(F.collect_list("lead").alias("first"))
    open_ = level.where("sha IS NULL").select("_id", "n_words", "_text", "place").join(first, "_id", "left")

    def cover(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        from newsloom.llm import kernels as K

        for batch in batches:
            removed, kept = [], []
            for text, place, first, n in zip(K.unsqueeze(batch.column("_text")), batch.column("place"), batch.column("first"), batch.column("n_words"), strict=True):
                found = text.as_py().encode().split()
                again = np.setdiff1d(place.values.to_numpy(), first.values.to_numpy() if first.is_valid else [])
                edge = np.zeros(n.as_py() + 1, np.int64)
                np.add.at(edge, again, 1)
                np.add.at(edge, again + window, -1)
                gone = np.cumsum(edge)[:-1] > 0
                removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(found, gone.tolist(), strict=True) if not g))
            sha = [hashlib.sha256(x).hexdigest() for x in kept]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("n_words"), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array([x.decode() for x in kept], pa.string())], names=["_id", "n_words", "n_removed", "kept_sha256", "kept"])

    changed = open_.mapInArrow(cover, "_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    same = level.where("sha IS NOT NULL").select("_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"), F.lit(None).cast("string").alias("kept"))
    return changed.unionByName(same).withColumnRenamed("_id", id_col)
