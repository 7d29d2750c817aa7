"""Jaccard join on word shingles: size-banded tiles, bitmap bounds, exact sorted intersections."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import Scratch, flushed
from encore.llm.graph import components
from encore.llm.hashing import bit_table, in_table, runs, word_hashes
from encore.session import cut_lineage, shuffle_partitions

WORDS = 5
PERCENT = 75
SAMPLE = 8  # one document in so many is counted to learn which shingles are frequent
FREQUENT = 2  # documents of that part from which on a shingle counts as frequent
BLOCK = 256  # sets on a side of a tile
LAGS = 4  # sets before it that a set is compared with at once, in order of size
WIDE = 16  # bits per element of the maps that decide which sets are moved
KEY_BITS = 48  # of a shingle's hash, to meet by; more sets meet if keys are equal by chance, and none fewer
_SEEN = 100_000


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    return np.unique(runs(word_hashes(text), words))


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """So many first elements of a set, in any order common to all sets, meet those of every set it links with."""
    return n - -(-percent * n // 100) + 1


def width_of(n: int, each: int = 4) -> int:
    """Bits of a set's signature: the power of two from ``each`` times n up, at least 64. Sets of one size band differ
    by one step."""
    return max(64, 1 << (each * n - 1).bit_length())


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted arrays without repeats share: the shorter one's places in the longer one, in order."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def signature(hashes: np.ndarray, each: int = 4) -> np.ndarray:
    """Bitmap of the hashes' low bits, as uint64 words."""
    width = width_of(len(hashes), each)
    flags = np.zeros(width, np.uint8)
    flags[(hashes & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").view(np.uint64)


def folded(words: np.ndarray, count: int) -> np.ndarray:
    """The signature at a smaller power of two, by laying its halves over each other."""
    while len(words) > count:
        words = words[: len(words) // 2] | words[len(words) // 2:]
    return words


def bounded_pairs(nodes, sizes, groups, maps, left, right, percent: int = PERCENT, best: bool = False):
    """Node pairs (of left x right, or above the diagonal if right is None) whose bit counts allow a link.

    Every bit that one map has and the other lacks stands for at least one element outside the intersection, so
    size - bits is an upper bound of the overlap. Pairs of equal group, or out of the size band, are left out. With
    ``best`` only the pair with the most room over the limit is returned for each node.
    """
    alone = right is None
    right = left if alone else right
    count = min(len(maps[i]) for i in (*left, *right))
    a, b = np.stack([folded(maps[i], count) for i in left]), np.stack([folded(maps[i], count) for i in right])
    size_a, size_b = sizes[left], sizes[right]
    fit = groups[left][:, None] != groups[right][None, :]
    fit &= (100 * size_a[:, None] >= percent * size_b[None, :]) & (100 * size_b[None, :] >= percent * size_a[:, None])
    if alone:
        fit &= np.triu(np.ones(fit.shape, bool), 1)
    i, j = np.nonzero(fit)
    found, room = [], []
    step = max(1, (4 << 20) // (8 * count))
    for k in range(0, len(i), step):
        x, y = i[k:k + step], j[k:k + step]
        common = np.bitwise_count(a[x] & b[y]).sum(1, dtype=np.int64)
        over_a = size_a[x] - (np.bitwise_count(a[x]).sum(1, dtype=np.int64) - common)
        over_b = size_b[y] - (np.bitwise_count(b[y]).sum(1, dtype=np.int64) - common)
        most = np.minimum(over_a, over_b)
        over = (100 + percent) * most - percent * (size_a[x] + size_b[y])
        good = over >= 0
        found.append(np.stack([nodes[left][x[good]], nodes[right][y[good]]], 1))
        room.append(over[good] / (size_a[x[good]] + size_b[y[good]]))
    if not found:
        return np.zeros((0, 2), np.int64)
    pairs = np.concatenate(found)
    if best:
        pairs = pairs[np.argsort(-np.concatenate(room), kind="stable")]
        pairs = pairs[np.union1d(*[np.unique(pairs[:, side], return_index=True)[1] for side in (0, 1)])]
    return pairs


def _read(docs: DataFrame, mode: str, table: bytes, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """What :func:`_pass` gives, written; the table goes from all machines afterwards."""
    shared = docs.sparkSession.sparkContext.broadcast(table)  # fixed size
    out = scratch.stored(_pass(docs, mode, shared, words, percent))
    shared.destroy()
    return out


def _pass(docs: DataFrame, mode: str, shared, words: int, percent: int) -> DataFrame:
    """One reading of the texts.

    ``count``: the first half of the shingles in hash order, to learn the frequent ones. ``index``: one row per
    document with its set's node and, once per task and node, its first shingles in the common order (rare before
    frequent, then by hash) and its bitmap. ``sets``: the sets of the documents that the bit table may hold.
    """
    kind = docs.schema["doc_id"].dataType
    schemas = {
        "count": "hash bigint",
        "index": f"doc_id {kind.simpleString()}, key bigint, n bigint, node bigint, first array<bigint>, map binary",
        "sets": "node bigint, n bigint, hashes array<bigint>, map binary",
    }

    def run(batches):
        import pyarrow as pa
        import xxhash
        from pyspark.sql.pandas.types import to_arrow_type

        bits = np.frombuffer(shared.value, np.uint8) if shared is not None else None
        long = pa.int64()
        schema = {
            "count": pa.schema([("hash", long)]),
            "index": pa.schema([("doc_id", to_arrow_type(kind)), ("key", long), ("n", long), ("node", long), ("first", pa.list_(long)), ("map", pa.binary())]),
            "sets": pa.schema([("node", long), ("n", long), ("hashes", pa.list_(long)), ("map", pa.binary())]),
        }[mode]
        seen: set[int] = set()

        def rows():
            for batch in batches:
                keys = batch.column(2).to_numpy(zero_copy_only=False)
                wanted = in_table(bits, keys.astype(np.uint64)) if mode == "sets" else None
                for at, (doc_id, text) in enumerate(zip(batch.column(0), batch.column(1))):
                    if wanted is not None and not wanted[at]:
                        continue
                    hashes = shingles(text.as_py(), words)
                    n = len(hashes)
                    if mode == "count":
                        for h in hashes[: (n + 1) // 2].view(np.int64).tolist():
                            yield (h,)
                        continue
                    node = xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)
                    if mode == "sets":
                        if n:
                            yield node, n, hashes.view(np.int64), signature(hashes, WIDE).tobytes()
                        continue
                    first = bitmap = None
                    if n and node not in seen:
                        if len(seen) >= _SEEN:
                            seen.clear()
                        seen.add(node)
                        size = prefix_size(n, percent)
                        order = np.argsort(in_table(bits, hashes), kind="stable")[:size]
                        first = (hashes[order] >> np.uint64(64 - KEY_BITS)).view(np.int64)
                        bitmap = signature(hashes).tobytes()
                    yield doc_id.as_py(), int(keys[at]), n, node if n else None, first, bitmap

        if mode == "count":
            held = []
            for row in rows():
                held.append(row[0])
                if len(held) >= 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(held, long)], schema=schema)
                    held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(held, long)], schema=schema)
            return
        weigh = (lambda r: 64 + (0 if r[4] is None else 8 * len(r[4]) + len(r[5]))) if mode == "index" else (
            lambda r: 64 + 8 * len(r[2]) + len(r[3]))
        yield from flushed(rows(), schema, weigh=weigh)

    return docs.mapInArrow(run, schemas[mode])


def _bounded(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose bitmaps allow a link."""
    one = maps.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("map").alias("ma"))
    two = maps.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("map").alias("mb"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep = []
            for row in zip(*[batch.column(c) for c in ("na", "nb", "ma", "mb")]):
                na, nb, ma, mb = (value.as_py() for value in row)  # one pair at a time, as maps can be large
                sizes, maps = np.array([na, nb]), [np.frombuffer(m, np.uint64) for m in (ma, mb)]
                ends = np.arange(2)
                keep.append(len(bounded_pairs(ends, sizes, ends, maps, ends[:1], ends[1:], percent)) > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(one, "a").join(two, "b").mapInArrow(run, "a bigint, b bigint")


def _verified(
    pairs: DataFrame, texts: DataFrame, index: DataFrame, words: int, percent: int, scratch: Scratch
) -> DataFrame:
    """The pairs (a, b) whose sets really overlap enough, by the intersection of their sorted arrays.

    The sets are made again from one document of each node in the pairs; a bit table of fixed size tells the reading
    tasks which ones, and the few more that it lets through meet no pair. Wider bitmaps of these sets rule out most
    pairs that fail, before any set moves.
    """
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    readers = index.where("node is not null").groupBy("node").agg(F.min("key").alias("key")).join(nodes, "node")
    sets = _read(texts, "sets", bit_table(readers, "key"), words, percent, scratch)
    pairs = scratch.stored(_bounded(pairs, sets.select("node", "n", "map"), percent).distinct())
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("hashes").alias("ha"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("hashes").alias("hb"))
    met = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "ha", "hb")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            na, nb = (batch.column(i).to_numpy() for i in (2, 3))
            both = np.array([
                overlap(*(batch.column(c)[i].values.to_numpy(zero_copy_only=False).view(np.uint64) for c in (4, 5)))
                for i in range(batch.num_rows)
            ], np.int64)
            good = (100 + percent) * both >= percent * (na + nb)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return scratch.stored(met.mapInArrow(run, "a bigint, b bigint").distinct())


def _tiles(members: DataFrame, maps: DataFrame, percent: int, best: bool, scratch: Scratch) -> DataFrame:
    """Candidate pairs of the members (lead, node, n, group) that share a lead and are in different groups.

    The lead of an element is the smallest node that has it; sets that share an element share its lead. Most elements
    of a family of near copies have one of few leads, so a pair meets a few times and not once per element. The
    members of a lead, in order of size, are cut into blocks of 256; every two blocks whose size bands meet, and each
    block with itself, are a tile. A tile is compared by its bitmaps in one piece and only the pairs that pass leave
    it, so a lead with very many members is spread over many tiles.
    """
    spark = members.sparkSession
    order = Window.partitionBy("lead").orderBy("n", "node")
    placed = scratch.stored(members.distinct().select(
        F.col("lead").alias("hash"), "node", "n", "group",
        F.floor((F.row_number().over(order) - 1) / BLOCK).cast("bigint").alias("block"),
    ))
    blocks = placed.groupBy("hash", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    later = blocks.select("hash", F.col("block").alias("other"), F.col("low").alias("other_low"))
    tiles = blocks.join(later, "hash").where(
        (F.col("other") >= F.col("block")) & (100 * F.col("high") >= percent * F.col("other_low"))
    ).select("hash", "block", "other")
    first = tiles.join(placed, ["hash", "block"]).select("hash", "block", "other", F.lit(0).alias("side"), "node", "n", "group")
    second = tiles.where("other > block").join(
        placed.withColumnRenamed("block", "other"), ["hash", "other"]
    ).select("hash", "block", "other", F.lit(1).alias("side"), "node", "n", "group")
    rows = first.unionByName(second).join(maps.select("node", "map"), "node").withColumn(
        "bucket", F.pmod(F.xxhash64("hash", "block", "other"), F.lit(8 * shuffle_partitions(spark)))
    )

    def compare(rows):
        import pyarrow as pa

        rows = rows.sort_by([("hash", "ascending"), ("block", "ascending"), ("other", "ascending"), ("side", "ascending")])
        cols = {c: rows.column(c).to_numpy() for c in ("hash", "block", "other", "side", "node", "n", "group")}
        maps = [np.frombuffer(m.as_py(), np.uint64) for m in rows.column("map")]
        tile = np.flatnonzero(np.r_[True, (np.diff(cols["hash"]) != 0) | (np.diff(cols["block"]) != 0) | (np.diff(cols["other"]) != 0)])
        found = []
        for start, end in zip(tile, np.r_[tile[1:], rows.num_rows]):
            at = np.arange(start, end)
            side = cols["side"][start:end]
            own = cols["block"][start] == cols["other"][start]
            left, right = (at, None) if own else (at[side == 0], at[side == 1])
            if len(left) and (own or len(right)):
                found.append(bounded_pairs(cols["node"], cols["n"], cols["group"], maps, left, right, percent, best))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        pairs = np.unique(np.sort(pairs, 1), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return rows.groupBy("bucket").applyInArrow(compare, "a bigint, b bigint").distinct()


def _merged(names: DataFrame, more: DataFrame, scratch: Scratch) -> DataFrame:
    """Components (node, component) after further links; only the names of the known ones go round again."""
    own = names.select(F.col("node").alias("a"), F.col("component").alias("na"))
    other = names.select(F.col("node").alias("b"), F.col("component").alias("nb"))
    lifted = more.join(own, "a", "left").join(other, "b", "left").select(
        F.coalesce("na", "a").alias("a"), F.coalesce("nb", "b").alias("b")
    )
    joined = components(lifted)
    known = names.join(
        joined.withColumnRenamed("node", "old").withColumnRenamed("component", "new"), F.col("component") == F.col("old"), "left"
    ).select("node", F.coalesce("new", "component").alias("component"))
    return scratch.stored(known.unionByName(joined.join(names.select("node"), "node", "left_anti")))


def jaccard_components(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, node (a hash of the set, null if it is empty), component_id.

    A text's set holds the distinct runs of ``words`` words with A-Z in lower case; a shorter text's only element is
    all of its words; without words the set is empty and links with nothing. Sets link when their intersection is at
    least ``percent`` % of their union. component_id is the smallest identifier that links reach.

    Equal sets are one node, whatever their number. Sets that link share one of their first quarter of elements in any
    common order; shingles found in many sampled documents come last in it, which changes the work and not the result.
    Elements shared by exactly the same sets count once. Sets that share one are in order of size; up to five are all
    compared with each other, of more each with the one before it first. Where the links found do not already join
    all of them, they are cut into size-banded tiles. All
    comparisons are made by hashed bitmaps first, whose bit counts bound the overlap from above; what passes is decided
    by the exact intersection.
    So a hot group of near copies costs a few comparisons per set and not one per pair, and no link between different
    components is lost. Hashes have 64 bits.

    A null text is empty; a null identifier counts for no component's name; repeated rows have one node; an empty
    table gives no rows; other columns are not read. Bit tables sent to the tasks have 8 MB at any size of the input; when
    very many shingles are frequent they fill up, and the order nears that of the hashes alone.
    """
    slim = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(F.col(id_col)).alias("key")
    )
    scratch = Scratch(docs.sparkSession)
    counted = _pass(slim.where(F.pmod("key", F.lit(SAMPLE)) == 0), "count", None, words, percent)
    frequent = counted.groupBy("hash").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= FREQUENT)
    index = _read(slim, "index", bit_table(frequent, "hash"), words, percent, scratch)

    order = Window.partitionBy("hash").orderBy("n", "node")
    members = Window.partitionBy("hash")
    met_by = scratch.stored(
        index.where("first is not null").select(F.explode("first").alias("hash"), "node", "n")
        .repartition(shuffle_partitions(docs.sparkSession), "hash").dropDuplicates(["hash", "node"])
        .select(
            "hash", "node", "n", F.row_number().over(order).alias("nth"), F.count(F.lit(1)).over(members).alias("of"),
            *[F.bit_xor(F.xxhash64("node", F.lit(i))).over(members).alias(f"who{i}") for i in (1, 2)],
            *[F.struct(F.lag("node", i).over(order).alias("node"), F.lag("n", i).over(order).alias("n")).alias(f"before{i}")
              for i in range(1, LAGS + 1)],
        )
        .where("of > 1")
        .select("hash", "node", "n", "nth", "of", "who1", "who2", F.transform(
            # all sets before it where they are few, else the nearest in size
            F.filter(
                F.slice(F.array(*[f"before{i}" for i in range(1, LAGS + 1)]), 1, F.when(F.col("of") <= LAGS + 1, LAGS).otherwise(1)),
                lambda x: 100 * x["n"] >= percent * F.col("n"),
            ),
            lambda x: x["node"],
        ).alias("before"))
    )
    # elements that exactly the same sets share say the same; one of them is kept
    kept = met_by.where("nth = 1").groupBy("of", "who1", "who2").agg(F.min("hash").alias("hash")).select("hash")
    shared = scratch.stored(met_by.drop("who1", "who2").join(kept, "hash", "left_semi"))
    met = shared.select("node").distinct()
    maps = scratch.stored(
        index.where("map is not null").select("node", "n", "map").join(met, "node", "left_semi").dropDuplicates(["node"])
    )
    first_pairs = shared.select("node", F.explode("before").alias("other")).select(
        F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")
    ).distinct()
    links = _verified(scratch.stored(_bounded(first_pairs, maps, percent)), slim, index, words, percent, scratch)
    names = components(links)
    # where no more than LAGS sets come before any other, all pairs have been compared
    open_ = shared.where(F.col("of") > LAGS + 1).select("hash", "node", "n")
    # first the most promising pair of every set, which joins most of a dense family, then all that are left
    for best in (True, False):
        grouped = open_.join(names, "node", "left").select("hash", "node", "n", F.coalesce("component", "node").alias("group"))
        apart = grouped.groupBy("hash").agg(
            F.min("group").alias("low"), F.max("group").alias("high"), F.min("node").alias("lead")
        ).where("low <> high")
        rest = _tiles(
            grouped.join(apart.select("hash", "lead"), "hash").select("lead", "node", "n", "group"), maps, percent, best,
            scratch,
        )
        more = _verified(scratch.stored(rest), slim, index, words, percent, scratch)
        if more.limit(1).count():
            names = _merged(names, more, scratch)
    named = index.join(names, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "node", F.coalesce("component", "node").alias("component")
    )
    smallest = named.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return scratch.finished(named.join(smallest, "component", "left").select(
        "doc_id", "n_shingles", "node",
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ))


def one_of_each(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each component of ``docs``, with all columns: the one of the smallest identifier, nulls last.

    Rows are told apart by a key of their own, not by their identifier, so rows of equal or null identifier stay or go
    one by one; of several with a component's smallest identifier, any one stays. The numbered rows go to the
    checkpoint folder, since their order may differ at a second read.
    """
    # one struct, so that no column of the input can clash
    rows = cut_lineage(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")))
    slim = rows.select("row", F.col("doc").getField(id_col).alias("id"), F.col("doc").getField(text_col).alias("text"))
    found = jaccard_components(slim.select("row", "text"), words, percent, "row", "text")
    ranked = found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("component")).join(slim.select("row", "id"), "row")
    rank = F.struct(F.col("id").isNull().alias("unnamed"), F.col("id"), F.col("row"))
    stays = ranked.groupBy("component").agg(F.min(rank).alias("least")).select(F.col("least.row").alias("row"))
    return rows.join(stays, "row", "left_semi").select("doc.*")
