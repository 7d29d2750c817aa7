"""Prefix trie of conversations by ROLLUP over positional turn columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.common import Scratch, before, ranged
from encore.llm.streamhash import sha256_of_runs

FIRST, FURTHER = 8, 16  # turns in the first block of columns, and in the others


def turn_rows(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """conv_id, turn, role, digest (SHA-256 of role and text), n_chars; a null role or text is empty.

    Rows without a conversation's identifier belong to none and are left out.
    """
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    whole = F.concat_ws(":", F.length(role).cast("string"), role, text)  # the length tells role and text apart
    return conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
        role.alias("role"), F.unhex(F.sha2(whole, 256)).alias("digest"), F.length(text).cast("bigint").alias("n_chars"),
    )


def positioned(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The rows with ``pos`` (from 1), and conv_id with ``size``.

    Equal turns are ordered by role, then by digest. The order is global, so a conversation of any length is spread.
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    placed = ranged(turns, order)
    totals = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per range partition
    placed = placed.join(F.broadcast(before(totals, "_part", {"_rows": "_before"})), "_part").withColumn(
        "place", F.col("_before") + F.col("_row")
    )
    sizes = scratch.stored(placed.groupBy("conv_id").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size")))
    rows = placed.join(sizes, "conv_id").select(
        "conv_id", (F.col("place") - F.col("first") + 1).alias("pos"), "digest", "n_chars"
    )
    return scratch.stored(rows), sizes.select("conv_id", "size")


def shared_openings(rows: DataFrame, sizes: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its first turns taken from the first of its block of ``every`` identifiers.

    ``h`` = CRC-32 of the decimal identifier, modulo ``most``; the first h turns come from the conversation c - c %
    every (all of it if it is shorter, none if there is none), then follow c's own turns after its first h. Returns
    rows and sizes as :func:`positioned` does.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("bigint")
    heads = rows.where((F.col("pos") < most) & (F.col("conv_id") % every == 0)).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", "n_chars"))).alias("head")  # below ``most`` turns
    )
    known = sizes.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    known = known.join(heads.withColumnRenamed("conv_id", "base"), "base", "left").withColumn(
        "head", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), 1, F.col("h").cast("int"))
    )
    shift = F.size("head").cast("bigint") - F.col("h")
    opening = known.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.pos", "t.digest", "t.n_chars")
    own = rows.join(known.select("conv_id", "h", shift.alias("shift")), "conv_id").where("pos > h")
    rebuilt = own.select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "digest", "n_chars")
    length = F.size("head") + F.greatest(F.col("size") - F.col("h"), F.lit(0))
    return opening.unionByName(rebuilt), known.select("conv_id", length.cast("bigint").alias("size"))


def _prefix_key(columns: list[Column]) -> Column:
    """One key for a run of digests; null if one of them is."""
    return F.sha2(F.concat(*columns), 256)


def _block(rows: DataFrame, members: DataFrame, offset: int, width: int) -> DataFrame:
    """conv_id, size, above (the node all this block hangs on), t1 .. tw: the digests of the block's positions."""
    inside = rows.where((F.col("pos") > offset) & (F.col("pos") <= offset + width))
    wide = inside.groupBy("conv_id").agg(
        *[F.max(F.when(F.col("pos") == offset + i, F.col("digest"))).alias(f"t{i}") for i in range(1, width + 1)],
        *[F.max(F.when(F.col("pos") == offset + i, F.col("n_chars"))).alias(f"l{i}") for i in range(1, width + 1)],
    )
    return members.join(wide, "conv_id", "left")


def _rolled_up(block: DataFrame, offset: int, width: int) -> DataFrame:
    """above, d, key, conv_id, n_convs: the block's prefixes that two conversations or more have.

    One ROLLUP counts the prefixes of every length together; ``grouping_id`` says how many columns are rolled up.
    """
    ts = [f"t{i}" for i in range(1, width + 1)]
    # gid is 2^r - 1 with r columns rolled up
    counted = block.rollup("above", *ts).agg(
        F.grouping_id().alias("gid"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")
    )
    depth = width - F.bit_count("gid").cast("int")
    held = F.size(F.array_compact(F.array(*ts)))
    # a prefix that ends in null columns is that of a conversation which ended before
    nodes = counted.withColumn("d", depth).where((F.col("d") > 0) & (held == F.col("d")) & (F.col("n_convs") > 1))
    key = F.sha2(F.concat(*[F.coalesce(t, F.lit(b"")) for t in ts]), 256)
    return nodes.select("above", "d", key.alias("key"), "conv_id", "n_convs")


def _paths(block: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """conv_id and path: the smallest member of each shared prefix in this block, shortest first."""
    prefixes = F.array(*[
        F.struct(F.lit(d).alias("d"), _prefix_key([F.col(f"t{i}") for i in range(1, d + 1)]).alias("key"))
        for d in range(1, width + 1)
    ])
    one = block.select(F.col("conv_id").alias("member"), "above", F.explode(prefixes).alias("p")).where("p.key is not null")
    named = one.select("member", "above", F.col("p.d").alias("d"), F.col("p.key").alias("key")).join(
        nodes, ["above", "d", "key"]
    )
    steps = F.array_sort(F.collect_list(F.struct("d", "conv_id")))  # at most the block's width
    return named.groupBy("member").agg(F.transform(steps, lambda s: s["conv_id"]).alias("path")).withColumnRenamed(
        "member", "conv_id"
    )


def _subtrees(nodes: DataFrame, width: int) -> DataFrame:
    """above, d, conv_id, n_leaves, saved_tokens summed over subtrees within a block, d = 0 for the whole block."""
    ms = [f"m{i}" for i in range(1, width + 1)]
    rows = nodes.select("above", "leaves", "saved", *[F.get("path", F.lit(i)).alias(m) for i, m in enumerate(ms)])
    summed = rows.rollup("above", *ms).agg(
        F.grouping_id().alias("gid"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )
    held = F.array_compact(F.array(*ms))
    depth = width - F.bit_count("gid").cast("int")
    return summed.withColumn("d", depth).where((F.col("d") >= 0) & (F.size(held) == F.col("d"))).select(
        "above", "d", F.coalesce(F.get(held, F.col("d") - 1), F.col("above")).alias("conv_id"), "n_leaves", "saved_tokens"
    )


def prefix_trie(
    rows: DataFrame, sizes: DataFrame, first: int = FIRST, further: int = FURTHER, scratch: Scratch | None = None
) -> DataFrame:
    """One row per node of the trie of ``rows`` (conv_id, pos from 1 without gaps, digest, n_chars); ``sizes`` names all.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. The root
    has every conversation, turnless ones too, and no parent. Without conversations there are no nodes.

    Positions become columns, a block of them at a time, and one ROLLUP over a block finds its prefixes. Only a
    conversation that shares a whole block with another one goes on to the next, keyed by that block's last node;
    what no other conversation shares is a chain of nodes with one member, which needs no counting. Sums over subtrees
    are a second ROLLUP, over the path of each shared node, from the last block to the first.
    """
    spark = rows.sparkSession
    scratch = scratch or Scratch(spark)
    root = sizes.agg(F.min("conv_id").alias("low"), F.count(F.lit(1)).alias("n")).first()
    blocks, stops = [], []
    members = sizes.select("conv_id", "size", F.lit(root["low"]).cast("bigint").alias("above"))
    offset, width = 0, first
    while True:
        block = scratch.stored(_block(rows, members, offset, width))
        nodes = scratch.stored(_rolled_up(block, offset, width))
        paths = scratch.stored(_paths(block, nodes, width))
        placed = scratch.stored(
            block.join(paths, "conv_id", "left").select(
                "conv_id", "size", "above", F.coalesce("path", F.array().cast("array<bigint>")).alias("path"),
                F.array(*[f"l{i}" for i in range(1, width + 1)]).alias("chars"),
            )
        )
        goes_on = (F.size("path") == width) & (F.col("size") > offset + width)
        stops.append(placed.where(~goes_on).select(
            "conv_id", "size", (F.size("path") + offset).cast("bigint").alias("depth"),
            F.when(F.size("path") > 0, F.get("path", F.size("path") - 1)).otherwise(F.col("above")).alias("at"),
        ))
        # the smallest member of a node has the node's path and the length of its last text
        named = nodes.drop("key").join(placed.select("conv_id", "path", "chars"), "conv_id").select(
            "above", "d", "conv_id", "n_convs", F.slice("path", 1, F.col("d")).alias("path"),
            F.get("chars", F.col("d") - 1).alias("last_chars"),
        )
        blocks.append((offset, width, scratch.stored(named)))
        members = scratch.stored(
            placed.where(goes_on).select("conv_id", "size", F.get("path", F.size("path") - 1).alias("above"))
        )
        if members.isEmpty():
            break
        rows = scratch.stored(rows.where(F.col("pos") > offset + width).join(members.select("conv_id"), "conv_id", "left_semi"))
        offset, width = offset + width, further
    return scratch.finished(_assembled(spark, scratch, blocks, stops, root))


def _assembled(spark: SparkSession, scratch: Scratch, blocks: list, stops: list, root) -> DataFrame:
    ended = stops[0]
    for more in stops[1:]:
        ended = ended.unionByName(more)
    ended = scratch.stored(ended)  # a row per conversation: its deepest shared node, at a depth
    chains = scratch.stored(ended.where("size > depth").groupBy("depth", "at").agg(F.count(F.lit(1)).alias("chains")))
    last = ended.where("size = depth").select("depth", "at", "conv_id", F.col("conv_id").cast("string").alias("name"))
    hashes = scratch.stored(sha256_of_runs(last, ["depth", "at"], ["conv_id"], "name", ",", "ends_sha256"))
    shared, sums, below = [], [], None
    for offset, width, nodes in reversed(blocks):
        here = nodes.withColumn("depth", (F.col("d") + offset).cast("bigint"))
        if offset == 0:
            top = spark.createDataFrame(
                [(root["low"], 0, root["low"], root["n"], [], 0, 0)] if root["n"] else [],
                "above bigint, d int, conv_id bigint, n_convs bigint, path array<bigint>, last_chars bigint, depth bigint",
            )
            here = here.unionByName(top)
        inner = here.where("d > 0").groupBy(
            (F.col("depth") - 1).alias("depth"),
            F.when(F.col("d") > 1, F.get("path", F.col("d") - 2)).otherwise(F.col("above")).alias("conv_id"),
        ).agg(F.count(F.lit(1)).alias("inner"))
        here = here.join(inner, ["depth", "conv_id"], "left").join(
            chains.withColumnRenamed("at", "conv_id"), ["depth", "conv_id"], "left"
        )
        carried = {"more": F.lit(0), "more_leaves": F.lit(0), "more_saved": F.lit(0)}
        if below is not None:
            here = here.join(below, ["depth", "conv_id"], "left")
            carried = {name: F.coalesce(name, F.lit(0)) for name in carried}
        none = F.lit(0)
        children = F.coalesce("inner", none) + F.coalesce("chains", none) + carried["more"]
        here = scratch.stored(here.select(
            "above", "d", "depth", "conv_id", "n_convs", "path", children.cast("bigint").alias("n_children"),
            (F.coalesce("chains", none) + (children == 0).cast("bigint") + carried["more_leaves"]).alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("last_chars") + carried["more_saved"]).alias("saved"),
        ))
        summed = scratch.stored(_subtrees(here, width))
        parent = F.when(F.col("d") > 1, F.get("path", F.col("d") - 2)).when(F.col("d") == 1, F.col("above"))
        shared.append(
            here.withColumn("parent_conv_id", parent).select(
                "depth", "conv_id", "parent_conv_id", "n_convs", "n_children"
            ).join(
                summed.where((F.col("d") > 0) | F.lit(offset == 0)).select(
                    (F.col("d") + offset).cast("bigint").alias("depth"), "conv_id", "n_leaves", "saved_tokens"
                ), ["depth", "conv_id"],
            )
        )
        if offset:
            # what hangs on the last node of the block above: its children there, and the sums of them all
            direct = here.where("d = 1").groupBy(F.col("above").alias("conv_id")).agg(F.count(F.lit(1)).alias("more"))
            below = scratch.stored(
                summed.where("d = 0").select(
                    F.lit(offset).cast("bigint").alias("depth"), "conv_id",
                    F.col("n_leaves").alias("more_leaves"), F.col("saved_tokens").alias("more_saved"),
                ).join(direct, "conv_id", "left").na.fill(0, ["more"])
            )
    whole = shared[0]
    for more in shared[1:]:
        whole = whole.unionByName(more)
    nothing = F.sha2(F.lit(b""), 256)
    whole = whole.join(hashes.withColumnRenamed("at", "conv_id"), ["depth", "conv_id"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
    # in steps, so that no array grows with a conversation
    lots = ended.where("size > depth").select(
        "*", F.explode(F.sequence(F.col("depth") + 1, F.col("size"), F.lit(4096))).alias("low")
    )
    alone = lots.select(
        "*", F.explode(F.sequence("low", F.least(F.col("low") + 4095, F.col("size")))).alias("deep")
    )
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    is_leaf = F.col("deep") == F.col("size")
    return whole.unionByName(alone.select(
        "conv_id", F.col("deep").alias("depth"),
        F.when(F.col("deep") == F.col("depth") + 1, F.col("at")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        one.alias("n_convs"), F.when(is_leaf, zero).otherwise(one).alias("n_children"), one.alias("n_leaves"),
        zero.alias("saved_tokens"),
        F.when(is_leaf, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(nothing).alias("ends_sha256"),
    ))


def conversation_trie(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", rebuild: bool = False, first: int = FIRST, further: int = FURTHER,
) -> DataFrame:
    """The prefix trie of a table of turns, in the order of ``turn`` (null first; equal turns by role, then by digest).

    With ``rebuild`` the conversations get :func:`shared_openings` first. Null roles and texts are empty; rows without
    an identifier belong to no conversation; an empty table has no nodes; other columns are not read.
    """
    scratch = Scratch(conversations.sparkSession)
    turns = turn_rows(conversations, id_col, turn_col, role_col, text_col)
    rows, sizes = positioned(turns, scratch)
    if rebuild:
        rows, sizes = shared_openings(rows, sizes)
        rows, sizes = scratch.stored(rows), scratch.stored(sizes)
    return prefix_trie(rows, sizes, first, further, scratch)
