"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.scratch import Scratch, connected_components

HASHES, ROWS, BITS = 128, 4, 4  # 32 bands of 4 minima; the low 4 bits of each minimum are kept
PLANES = 2 * BITS  # longs: HASHES / 64 for each retained bit


def shingle_set(hashes, width: int):
    """Distinct shingle hashes, sorted; fewer words than width: the whole sequence as one."""
    import numpy as np

    from newsloom.llm.kernels import ngrams

    return np.unique(ngrams(hashes, min(width, len(hashes)), salt=min(width, len(hashes))))


def sequence_key(hashes) -> tuple:
    """Two 64-bit sums over a word sequence, each mixed in its own way with the words' places."""
    import numpy as np

    from newsloom.llm import kernels as K

    place = K.mix(np.arange(len(hashes), dtype=K.U))
    return (hashes * (place | K.U(1))).sum(), K.mix(hashes ^ place).sum()


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """Per row: n_shingles, the word sequence's 128-bit key, packed low bits and band keys."""
    rows = docs.select(docs[id_col].cast("long").alias("_id"), docs[text_col].cast("string").alias("_text"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from newsloom.llm import kernels as K

        multiply = K.mix(np.arange(1, HASHES + 1, dtype=K.U)) | K.U(1)
        add = K.mix(np.arange(1001, 1001 + HASHES, dtype=K.U))
        names = ["_id", "n_shingles", "k1", "k2", *(f"p{i}" for i in range(PLANES)), "bands"]
        for batch in batches:
            for part in K.slices(batch, "_text"):
                n = part.num_rows
                hashes, at = K.words(part.column("_text"), fold=K.FOLD)
                count, keys = np.zeros(n, np.int64), np.zeros((n, 2), K.U)
                minima = np.zeros((n, HASHES), K.U)
                for i in range(n):
                    own = hashes[at[i] : at[i + 1]]
                    if not len(own):
                        continue
                    keys[i] = sequence_key(own)
                    shingles = shingle_set(own, width)
                    count[i] = len(shingles)
                    low = np.full(HASHES, ~K.U(0), K.U)
                    for a in range(0, len(shingles), 4096):
                        x = shingles[a : a + 4096, None] * multiply
                        x += add
                        x ^= x >> K.U(32)  # the low bits of a product depend on few bits of its factors
                        np.minimum(low, x.min(axis=0), out=low)
                    minima[i] = low
                minima = K.mix(minima)
                planes = []
                for bit in range(BITS):
                    on = ((minima >> K.U(bit)) & K.U(1)).astype(np.uint8)
                    planes += list(np.packbits(on, axis=1, bitorder="little").view(np.int64).reshape(n, -1).T)
                bands = minima.reshape(n, HASHES // ROWS, ROWS)
                key = np.zeros(bands.shape[:2], K.U)
                for r in range(ROWS):
                    key = K.mix(key * K.U(3) + bands[:, :, r])
                key = K.mix(key + np.arange(HASHES // ROWS, dtype=K.U))
                flat = pa.array(K.signed(key.ravel()), pa.int64())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * key.shape[1]), flat)
                longs = [pa.array(np.ascontiguousarray(x), pa.int64()) for x in (count, K.signed(keys[:, 0].copy()), K.signed(keys[:, 1].copy()), *planes)]
                yield pa.RecordBatch.from_arrays([part.column("_id"), *longs, lists], names=names)

    return rows.mapInArrow(run, f"_id long, n_shingles long, k1 long, k2 long, {', '.join(f'p{i} long' for i in range(PLANES))}, bands array<long>")


def estimate(a: str, b: str):
    """Similarity from the packed bits of rows a and b, corrected for chance agreement.

    A position agrees if all its kept bits do: the planes' differences are
    joined by OR and the zeros counted. Different minima agree with 2^-BITS.
    """
    zeros = F.lit(0)
    for word in range(2):
        differ = F.lit(0).cast("long")
        for bit in range(BITS):
            plane = f"p{bit * 2 + word}"
            differ = differ.bitwiseOR(F.col(f"{a}.{plane}").bitwiseXOR(F.col(f"{b}.{plane}")))
        zeros = zeros + (64 - F.bit_count(differ))
    chance = 2.0**-BITS
    return (zeros / HASHES - chance) / (1 - chance)


def confirm(pairs: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Of pairs (a, b), those with share[1] * intersection >= share[0] * union."""
    num, den = share
    both = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b").select("a", "b", "sa", "sb")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * same >= num * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def cells(scratch: Scratch, rows: DataFrame, key: str, most: int, size: str, most_bytes: int, lone: str | None = None) -> tuple[DataFrame, int]:
    """Rows dealt to cells (key, i, j) so that any two rows of a key meet in one and no cell is large; and a number of calls.

    A key's rows fall by hash into blocks of about ``most`` rows and
    ``most_bytes`` bytes (of column ``size``), whichever gives more blocks; a
    cell holds two blocks, a single larger row by itself still being whole.
    With ``lone``, only pairs with such a row are asked for: blocks of lone
    rows (i) meet one another and blocks of the others (j), which are numbered
    after them. Adds _left: whether a row is of block i. The calls are so many
    that about 16 blocks' worth of rows and bytes fall to each.
    """
    flag = F.col(lone) if lone else F.lit(True)
    weigh = lambda own: F.greatest(F.ceil(F.count_if(own) / most), F.ceil(F.coalesce(F.sum(F.when(own, F.col(size))), F.lit(0)) / most_bytes))
    sizes = scratch.write(
        rows.groupBy(F.col(key).alias("_key")).agg(
            weigh(flag).cast("long").alias("_bi"), weigh(~flag).cast("long").alias("_bj"), F.count_if(flag).alias("_ni"), F.count_if(~flag).alias("_nj"),
            F.sum(F.when(flag, F.col(size)).otherwise(0)).alias("_si"), F.sum(F.when(flag, 0).otherwise(F.col(size))).alias("_sj"),
        ),
        "sizes",
    )
    # a lone row is in as many cells as there are blocks, another in as many as there are lone blocks
    dealt_out = lambda i, j: F.sum(F.col(i).cast("double") * (F.col("_bi") + F.col("_bj")) + F.col(j).cast("double") * F.col("_bi"))
    total = sizes.agg(dealt_out("_ni", "_nj").alias("rows"), dealt_out("_si", "_sj").alias("bytes")).first()
    calls = max(int(scratch.spark.conf.get("spark.sql.shuffle.partitions")), int((total["rows"] or 0) / (16 * most)) + 1, int((total["bytes"] or 0) / (16 * most_bytes)) + 1)
    own = rows.join(sizes.select("_key", "_bi", "_bj"), F.col(key) == F.col("_key"))
    place = F.when(flag, F.pmod(F.xxhash64("rep"), "_bi")).otherwise(F.col("_bi") + F.pmod(F.xxhash64("rep"), "_bj"))
    own = own.withColumn("_b", place)
    last = F.col("_bi") + F.col("_bj") - 1
    as_left = F.transform(F.sequence(F.col("_b"), last), lambda j: F.struct(F.col("_b").alias("i"), j.alias("j"), F.lit(True).alias("left")))
    as_right = F.transform(F.sequence(F.lit(0).cast("long"), F.least(F.col("_b"), F.col("_bi")) - 1), lambda i: F.struct(i.alias("i"), F.col("_b").alias("j"), F.lit(False).alias("left")))
    nothing = F.array().cast("array<struct<i:bigint,j:bigint,left:boolean>>")
    places = F.concat(F.when(flag, as_left).otherwise(nothing), F.when(F.least("_b", "_bi") > 0, as_right).otherwise(nothing))
    dealt = own.withColumn("_c", F.explode(places)).select(*rows.columns, F.col("_c.i").alias("_i"), F.col("_c.j").alias("_j"), F.col("_c.left").alias("_left"))
    return dealt.withColumn("_cell", F.xxhash64(key, "_i", "_j")), calls


def per_cell(dealt: DataFrame, calls: int, work) -> DataFrame:
    """Edges (a, b) that work(table of one cell) yields; many small cells share one of ``calls`` calls."""

    def run(table):
        import numpy as np
        import pyarrow as pa

        table = table.combine_chunks().sort_by([("_cell", "ascending"), ("_left", "descending"), ("rep", "ascending")])
        cell = table.column("_cell").to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])).tolist() + [len(cell)]
        a, b = [], []
        for i, j in zip(cuts, cuts[1:], strict=False):
            if j - i > 1:
                for x, y in work(table.slice(i, j - i)):
                    a.append(x)
                    b.append(y)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy(F.pmod(F.xxhash64("_cell"), F.lit(calls)).alias("_call")).applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: tuple[int, int] = (8, 10), width: int = 5, margin: float = 0.18) -> DataFrame:
    """Per row: id, n_shingles, component_id, kept.

    Words are runs without ASCII white space, A-Z lower-cased; a set holds the
    distinct shingles of ``width`` words. Rows are linked if
    share[1] * intersection >= share[0] * union; component_id is the smallest
    id reachable.

    1. One pass gives each row its 128 minima, of which the low 4 bits are
       packed into 8 longs, and 32 band keys. Rows of one word sequence form
       a class, known by a number of its own; only that goes on.
    2. Members of a band bucket are compared with that of the smallest id. A pair
       is a candidate if the estimate from the packed bits, corrected for
       chance agreement, is within ``margin`` (over five standard deviations)
       of the threshold. Candidates are confirmed on the full sets. So most of
       a group of similar rows is linked in proportion to its size.
    3. What is still in different components of one bucket is compared by the
       packed bits, and rows that candidates tie together form a cluster. In
       each cluster, rows outside its largest-known component meet all others
       by their full sets. Both comparisons run in cells of bounded rows and
       bytes and return one edge for each merger, not each pair.

    A pair at similarity s shares no band with probability (1 - s^4)^32: 5e-11
    at 0.85, 5e-8 at 0.8. Null or empty texts have no shingles and no links.
    Rows with a null id have a null component and are kept. Repeated ids are
    judged row by row, by their own texts. Other columns are ignored; an empty
    table gives an empty table.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    num, den = share
    signed = scratch.write(signatures(docs, id_col, text_col, width), "signatures")
    keyed = signed.where("n_shingles > 0 AND _id IS NOT NULL")
    planes = [f"p{i}" for i in range(PLANES)]
    least_id = keyed.groupBy("k1", "k2").agg(F.min("_id").alias("low"))
    reps = keyed.join(least_id, ["k1", "k2"]).where("_id = low").select("k1", "k2", "low", "n_shingles", *planes, "bands").dropDuplicates(["k1", "k2"])
    # the number is fixed by being written
    reps = scratch.write(reps.withColumn("rep", F.monotonically_increasing_id()), "classes")

    banded = reps.select("rep", "low", F.explode("bands").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.min_by("rep", "low").alias("center"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = scratch.write(banded.join(buckets, "bucket").select("bucket", "center", "rep"), "members")
    bits = reps.select("rep", "n_shingles", *planes)
    least = num / den - margin

    x, y = bits.alias("x"), bits.alias("y")
    stars = members.where("rep <> center").select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct().alias("p")
    likely = stars.join(x, F.col("p.a") == F.col("x.rep")).join(y, (F.col("p.b") == F.col("y.rep")) & (den * F.least("x.n_shingles", "y.n_shingles") >= num * F.greatest("x.n_shingles", "y.n_shingles")) & (estimate("x", "y") >= least))
    first = scratch.write(likely.select("p.a", "p.b"), "pairs")
    wanted = members.select("rep").distinct().join(reps.select("rep", "low", "k1", "k2"), "rep")
    texts = docs.select(docs[id_col].cast("long").alias("_id"), docs[text_col].cast("string").alias("_text")).join(wanted.select(F.col("low").alias("_id")), "_id", "left_semi")

    def to_sets(batches):
        import numpy as np
        import pyarrow as pa

        from newsloom.llm import kernels as K

        for batch in batches:
            for part in K.slices(batch, "_text"):
                hashes, at = K.words(part.column("_text"), fold=K.FOLD)
                each = [hashes[at[i] : at[i + 1]] for i in range(part.num_rows)]
                keys = np.array([sequence_key(own) for own in each], K.U).reshape(-1, 2)
                found = [shingle_set(own, width).tobytes() for own in each]
                yield pa.RecordBatch.from_arrays([*(pa.array(K.signed(np.ascontiguousarray(keys[:, i])), pa.int64()) for i in (0, 1)), pa.array(found, pa.binary())], names=["k1", "k2", "shingles"])

    # by its word sequence, for an id may be repeated with another text
    sets = texts.mapInArrow(to_sets, "k1 long, k2 long, shingles binary").where("length(shingles) > 0").join(wanted.select("k1", "k2", "rep"), ["k1", "k2"])
    sets = scratch.write(sets.dropDuplicates(["k1", "k2"]).select("rep", "shingles"), "sets")
    links = scratch.write(confirm(first, sets, share), "links")
    scratch.drop(first)
    parts = scratch.write(connected_components(scratch, links), "components")

    # members of one bucket that are in different components yet
    placed = members.join(parts, members.rep == parts.node, "left").select("bucket", "rep", F.coalesce("component", "rep").alias("component"))
    open_ = placed.groupBy("bucket").agg(F.min("component").alias("_main"), F.max("component").alias("_other")).where("_main < _other").select("bucket")
    open_ = scratch.write(placed.join(open_, "bucket").join(bits, "rep").withColumn("_bytes", F.lit(8 * (PLANES + 4))), "open")
    scratch.drop(members)

    def tie(table):
        """Edges that join components by candidates, by the packed bits."""
        import numpy as np

        n = table.num_rows
        rep, size = table.column("rep").to_numpy(), table.column("n_shingles").to_numpy()
        label = np.unique(table.column("component").to_numpy(), return_inverse=True)[1]
        packed = np.stack([table.column(p).to_numpy() for p in planes], axis=1).view(np.uint64)
        chance = 2.0**-BITS
        for i in range(n):
            other = np.flatnonzero(label != label[i])
            if not len(other):
                return
            differ = packed[other] ^ packed[i]
            zeros = 0
            for word in range(2):
                zeros = zeros + 64 - np.bitwise_count(np.bitwise_or.reduce(differ[:, word::2], axis=1)).astype(int)
            near = ((zeros / HASHES - chance) / (1 - chance) >= least) & (den * np.minimum(size[other], size[i]) >= num * np.maximum(size[other], size[i]))
            for j in other[near].tolist():
                if label[j] != label[i]:
                    yield rep[i], rep[j]
                    label[label == label[j]] = label[i]

    def link(table):
        """Edges that join components by links on full sets."""
        import numpy as np

        left = table.column("_left").to_numpy(zero_copy_only=False)
        rep = table.column("rep").to_numpy()
        label = np.unique(table.column("component").to_numpy(), return_inverse=True)[1]
        held = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("shingles")]
        size = np.array([len(v) for v in held])
        at = np.concatenate([[0], np.cumsum(size)])
        _, word = np.unique(np.concatenate(held), return_inverse=True)
        order = np.argsort(word, kind="stable")
        row = np.repeat(np.arange(len(held)), size)[order]
        start = np.concatenate([[0], np.cumsum(np.bincount(word))])
        for i in np.flatnonzero(left):
            if (label == label[i]).all():
                return
            mine = word[at[i] : at[i + 1]]
            lengths = start[mine + 1] - start[mine]
            spots = np.repeat(start[mine] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
            same = np.bincount(row[spots], minlength=len(held))
            near = (den * same >= num * (size + size[i] - same)) & (label != label[i])
            for j in np.flatnonzero(near).tolist():
                if label[j] != label[i]:
                    yield rep[i], rep[j]
                    label[label == label[j]] = label[i]

    ties = scratch.write(per_cell(*cells(scratch, open_, "bucket", 2048, "_bytes", 1 << 20), tie), "ties")
    if not ties.isEmpty():
        clusters = connected_components(scratch, links.unionByName(ties)).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
        inside = clusters.join(parts, clusters.rep == parts.node, "left").select("rep", "cluster", F.coalesce("component", "rep").alias("component"))
        inside = scratch.write(inside, "inside")
        sizes = inside.groupBy("cluster", "component").count()
        main = sizes.groupBy("cluster").agg(F.max_by("component", F.struct("count", "component")).alias("main"), F.count("*").alias("n")).where("n > 1").drop("n")
        inside = inside.join(main, "cluster").withColumn("apart", F.col("component") != F.col("main")).drop("main")
        inside = scratch.write(inside.join(reps.select("rep", (F.col("n_shingles") * 8).alias("_bytes")), "rep"), "clusters")
        dealt, calls = cells(scratch, inside, "cluster", 256, "_bytes", 2 << 20, "apart")
        more = scratch.write(per_cell(dealt.join(sets, "rep"), calls, link), "links")
        if not more.isEmpty():
            parts = scratch.write(connected_components(scratch, links.unionByName(more)), "components")
    scratch.drop(sets, open_, ties)

    # a component is known by its smallest number; its id is the smallest of its rows'
    named = reps.select("k1", "k2", "rep", "low").join(parts, reps.rep == parts.node, "left").select("k1", "k2", "low", "component")
    tops = named.where("component IS NOT NULL").groupBy("component").agg(F.min("low").alias("_top"))
    named = named.join(tops, "component", "left").select("k1", "k2", F.coalesce("_top", "low").alias("component_id"))
    out = signed.select("_id", "n_shingles", "k1", "k2").join(named, ["k1", "k2"], "left").select(F.col("_id").alias(id_col), "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"))
    out = out.withColumn("component_id", F.when(F.col(id_col).isNotNull(), F.col("component_id")))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
