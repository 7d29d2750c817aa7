"""Structure repair of conversations with Four-Russians block tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import Scratch, before, flushed, ranged
from encore.llm.streamhash import sha256_of_runs

SPACES = " \t\n\x0b\x0c\r"
SEGMENT = 2048  # rows of a conversation that one call of the tables takes
_KEY = ["c", "void"]  # the identifier, and whether it is null: a null is a conversation as well


def _or_space(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def readable(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """conv_id, turn, role, text under fixed names; a null role or text is one space."""
    return conversations.select(
        F.col(id_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
        _or_space(role_col).alias("role"), _or_space(text_col).alias("text"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of :func:`readable` with the faults that CRC-32 of ``conv_id:turn`` (a null is one space) modulo 20 names.

    0 drops a row, 1 empties its text, 2 takes ``.``, ``!`` and ``?`` out of it, 3 repeats it, 4 sets the role user.
    """
    key = F.concat_ws(":", _or_space("conv_id"), _or_space("turn"))
    fault = F.crc32(key.cast("binary")) % 20
    times = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("_copy"),
    ).drop("_copy")


def _coded(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rows in order (c, void, place, turn, role, text, initial, digest, fault), and the place of each conversation's first."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    marked = rows.select(
        F.coalesce("conv_id", F.lit(0)).alias("c"), F.col("conv_id").isNull().alias("void"), "turn", "role", "text",
        F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)).alias("digest"),
        F.coalesce(F.nullif(F.instr(F.lit("sua"), initial) * (initial != "").cast("int"), F.lit(0)) - 1, F.lit(3)).alias("initial"),
        F.when(trimmed == "", 2).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1).alias("flaw"),
    )
    order = [F.col("c"), F.col("void"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    placed = ranged(marked, order)
    totals = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per range partition
    placed = scratch.stored(placed.join(F.broadcast(before(totals, "_part", {"_rows": "_before"})), "_part").select(
        (F.col("_before") + F.col("_row")).alias("place"), *marked.columns
    ))
    again = placed.groupBy(*_KEY, "digest").agg(F.min("place").alias("once"), F.count(F.lit(1)).alias("n")).where("n > 1")
    seen = F.col("once").isNotNull() & (F.col("place") > F.col("once"))
    light = placed.drop("text", "role").join(again.drop("n"), [*_KEY, "digest"], "left")
    # 0 none, 1 truncated, 2 blank, 3 duplicate
    coded = light.select(
        *_KEY, "place", "turn", "initial",
        F.when(F.col("flaw") == 2, 2).when(seen, 3).otherwise(F.col("flaw")).alias("fault"),
    )
    return placed.select(*_KEY, "place", "role", "text"), scratch.stored(coded)


def _counts(coded: DataFrame) -> DataFrame:
    """c, void, first, n, gaps, blank, duplicate, truncated."""
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return coded.groupBy(*_KEY).agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n"), F.coalesce(span, F.lit(0)).alias("gaps"),
        *[F.count_if(F.col("fault") == k).alias(name) for k, name in ((2, "blank"), (3, "duplicate"), (1, "truncated"))],
    )


def _segments(coded: DataFrame, counts: DataFrame) -> DataFrame:
    """c, void, seg, segs, start, codes (initial * 4 + fault of at most ``SEGMENT`` rows)."""
    seg = ((F.col("place") - F.col("first")) / SEGMENT).cast("bigint")
    codes = F.array_sort(F.collect_list(F.struct("place", (F.col("initial") * 4 + F.col("fault")).alias("code"))))
    return coded.join(counts.select(*_KEY, "first", "n"), _KEY).groupBy(
        *_KEY, seg.alias("seg"), F.ceil(F.col("n") / SEGMENT).alias("segs")
    ).agg(F.min("place").alias("start"), F.transform(codes, lambda x: x["code"]).alias("codes"))


def _symbols(codes):
    """Symbols of the tables: blank rows and duplicates are one."""
    import numpy as np

    from encore.llm.blocktables import GONE

    initial, fault = np.divmod(np.array(codes, np.int64), 4)
    return np.where(fault > 1, GONE, initial * 2 + fault)


def _through(batches):
    """c, void, seg -> the vector before the segment for each vector after it."""
    import pyarrow as pa

    from encore.llm.blocktables import through

    for batch in batches:
        made = [through(_symbols(codes))[0].tolist() for codes in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(made, pa.list_(pa.int32()))], names=["c", "void", "seg", "maps"]
        )


def _follow(batches):
    """Rows in order: from 0 at each conversation's first row, what one segment's map hands to the next."""
    import pyarrow as pa

    at, key = 0, None
    for batch in batches:
        out = []
        for now, maps in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), batch.column(3)):
            if now != key:
                at, key = 0, now
            out.append(at)
            at = maps[at].as_py()
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.int32())], names=["c", "void", "seg", "got"])


def _leads(batches):
    """c, void, seg -> the state after the segment for each state before it."""
    import pyarrow as pa

    from encore.llm.blocktables import trace

    for batch in batches:
        made = [
            [trace(_symbols(codes), vector, state, False)[2] for state in range(4)]
            for codes, vector in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())
        ]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(made, pa.list_(pa.int32()))], names=["c", "void", "seg", "maps"]
        )


def _followed(maps: DataFrame, name: str, backward: bool) -> DataFrame:
    """Composes the segments' maps along each conversation, a segment at a time."""
    order = F.col("seg").desc() if backward else F.col("seg")
    return maps.repartition(*_KEY).sortWithinPartitions(*_KEY, order).mapInArrow(
        _follow, f"c bigint, void boolean, seg bigint, {name} int"
    )


def _traced(batches):
    """One row a segment: its audit, cost, illegal neighbours inside it, and for every row what is written."""
    import pyarrow as pa

    from encore.llm.blocktables import CHANGE, CUT, DELETE, INSERT, trace

    cost_of = {"K": 0, "R": CHANGE, "D": DELETE}
    legal = {(0, 1), (1, 2), (2, 1)}
    fields = [
        ("c", pa.int64()), ("void", pa.bool_()), ("seg", pa.int64()), ("start", pa.int64()), ("audit", pa.string()),
        ("cost", pa.int64()), ("illegal", pa.int64()), ("inserted", pa.list_(pa.string())), ("edits", pa.string()),
        ("written", pa.list_(pa.string())), ("tail", pa.string()),
    ]

    def rows():
        for batch in batches:
            for c, void, seg, segs, start, codes, before_it, vector, state in zip(*[x.to_pylist() for x in batch.columns]):
                made, tail, _ = trace(_symbols(codes), vector, state, seg == segs - 1)
                audit = "".join("I" * len(i) + e for i, e, _ in made) + "I" * len(tail)
                cost = sum(cost_of[e] + INSERT * len(i) + CUT * (e != "D" and k % 4 == 1) for (i, e, _), k in zip(made, codes))
                initials = ([] if before_it is None else [before_it // 4]) + [k // 4 for k in codes]
                yield (
                    c, void, seg, start, audit, cost + INSERT * len(tail),
                    sum(pair not in legal for pair in zip(initials, initials[1:])), [i for i, _, _ in made],
                    "".join(e for _, e, _ in made), [r for _, _, r in made], tail,
                )

    yield from flushed(rows(), pa.schema(fields), weigh=lambda r: 200 + 40 * len(r[8]))


_TRACED = (
    "c bigint, void boolean, seg bigint, start bigint, audit string, cost bigint, illegal bigint, "
    "inserted array<string>, edits string, written array<string>, tail string"
)
_NAMES = {"u": "user", "a": "assistant"}


def _edits(segments: DataFrame, scratch: Scratch) -> DataFrame:
    """The cheapest edits of every segment.

    A conversation of one segment starts and ends in it. For longer ones each segment's map from the vector after it to
    the vector before it is composed from the last segment to the first, then the map from state to state from the
    first to the last, so that only one small row of a segment passes through a conversation's task.
    """
    nothing = F.lit(None).cast("int")
    single = segments.where("segs = 1").select(
        "c", "void", "seg", "segs", "start", "codes", nothing.alias("before_it"), F.lit(0).alias("vector"), F.lit(0).alias("state")
    )
    long = segments.where("segs > 1")
    if not long.isEmpty():
        held = [*_KEY, "seg"]
        long = scratch.stored(long)
        maps = long.select(*held, "codes").mapInArrow(_through, "c bigint, void boolean, seg bigint, maps array<int>")
        after = scratch.stored(_followed(maps, "vector", True))
        long = long.join(after, held)
        leads = long.select(*held, "codes", "vector").mapInArrow(_leads, "c bigint, void boolean, seg bigint, maps array<int>")
        entered = scratch.stored(_followed(leads, "state", False))
        lasts = long.select(*_KEY, (F.col("seg") + 1).alias("seg"), F.element_at("codes", -1).alias("before_it"))
        long = long.join(entered, held).join(lasts, held, "left")
        single = single.unionByName(long.select(*single.columns))
    return single.mapInArrow(_traced, _TRACED)


def _lines(texts: DataFrame, edits: DataFrame) -> DataFrame:
    """c, void, place, sub, line: the repaired rows as role:text, with what is inserted before each."""
    added = lambda roles: F.transform(
        F.filter(F.split(roles, ""), lambda r: r != ""), lambda r: F.when(r == "u", "user:").otherwise("assistant:")
    )
    each = edits.select("start", F.posexplode(F.arrays_zip("inserted", "written")).alias("i", "x"), "edits").select(
        (F.col("start") + F.col("i")).alias("place"), F.col("x.inserted").alias("inserted"),
        F.col("x.written").alias("new"), F.substring(F.col("edits"), F.col("i") + 1, F.lit(1)).alias("edit"),
    ).where("edit <> 'D' or inserted <> ''")
    role = F.when(F.col("edit") == "K", F.col("role")).when(F.col("new") == "u", "user").otherwise("assistant")
    own = F.when(F.col("edit") == "D", F.array().cast("array<string>")).otherwise(
        F.array(F.concat(role, F.lit(":"), F.col("text")))
    )
    kept = texts.join(each, "place").select(
        *_KEY, "place", F.lit(0).alias("sub"), F.array_join(F.concat(added(F.col("inserted")), own), "\n").alias("line")
    )
    ends = edits.where("tail <> ''").select(
        *_KEY, (F.col("start") + F.length("edits") - 1).alias("place"), F.lit(1).alias("sub"),
        F.array_join(added(F.col("tail")), "\n").alias("line"),
    )
    return kept.unionByName(ends)


def _repair(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    texts, coded = _coded(rows, scratch)
    counts = scratch.stored(_counts(coded))
    edits = scratch.stored(_edits(scratch.stored(_segments(coded, counts)), scratch))
    return counts, edits, scratch.stored(_lines(texts, edits))


def repaired_lines(rows: DataFrame) -> DataFrame:
    """conv_id, place, sub, line: the repaired conversations, a line ``role:text`` for each row that stays.

    In the order of place and sub; where roles were inserted, ``line`` has a line for each of them, parted by a line
    feed. Null roles and texts are to be made :func:`readable` first. See :func:`repair_report`.
    """
    scratch = Scratch(rows.sparkSession)
    lines = _repair(rows, scratch)[2]
    return scratch.finished(lines.select(F.when(~F.col("void"), F.col("c")).alias("conv_id"), "place", "sub", "line"))


def repair_report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """What the repair does to rows (conv_id, turn, role, text): one row per conversation, those of ``ids`` too.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Rows are ordered by turn (null
    first), equal ones by role, then by digest. A role that does not start with s, u or a can only be changed or
    deleted. A null identifier is a conversation as well. Null roles and texts are to be made :func:`readable` first.
    The audit has a letter for every edit and so grows with its conversation; all else is held by segments of 2,048
    rows. Other columns are not read. An empty table gives no rows.
    """
    scratch = Scratch(rows.sparkSession)
    counts, edits, lines = _repair(rows, scratch)
    hashes = sha256_of_runs(lines, _KEY, ["place", "sub"], "line", "\n", "repaired_sha256", pack=False)
    parts = F.array_sort(F.collect_list(F.struct("seg", "audit")))
    summed = edits.groupBy(*_KEY).agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit"),
    )
    named = (rows if ids is None else ids).select(
        F.coalesce("conv_id", F.lit(0)).alias("c"), F.col("conv_id").isNull().alias("void")
    ).distinct()
    whole = named.join(counts, _KEY, "left").join(summed, _KEY, "left").join(hashes, _KEY, "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return scratch.finished(whole.select(
        F.when(~F.col("void"), F.col("c")).alias("conv_id"),
        *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    ))
