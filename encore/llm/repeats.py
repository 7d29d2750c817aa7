"""Passages that repeat across documents, by sparse suffix arrays."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import Scratch, flushed, id_and_text
from encore.llm.hashing import bit_table, in_table, mixed, powers_to, runs, word_hashes
from encore.session import shuffle_partitions

MIN_WORDS = 50
GRAM = 10
SUFFIX_BYTES = 1 << 22  # suffixes hashed at once, give or take one
RUN = 4096  # suffixes of one document on end that wait for the next document
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over every window of ``size`` values, by doubling."""
    out, width = values, 1
    while 2 * width <= size:
        out, width = pick(out[:-width], out[width:]), 2 * width
    return pick(out[: len(out) - (size - width)], out[size - width:]) if width < size else out


def anchors(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions that hold the least gram of some window of ``window`` grams; equal grams count alike."""
    if len(grams) < window:
        return np.zeros(0, np.int64)
    least = _sliding(grams, window, np.minimum)
    # least never exceeds a gram of its window, so a gram is some window's least if the greatest of theirs equals it
    padded = np.concatenate([np.zeros(window - 1, np.uint64), least, np.zeros(window - 1, np.uint64)])
    return np.flatnonzero(_sliding(padded, window, np.maximum) == grams)


def _anchor_rows(docs: DataFrame, min_words: int, gram: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        schema = pa.schema([("hash", pa.int64()), ("doc_id", to_arrow_type(kind)), ("pos", pa.int32())])

        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0), batch.column(1)):
                    hashes = word_hashes(text.as_py())
                    if len(hashes) < min_words:
                        continue
                    grams = runs(hashes, gram)
                    at = anchors(grams, min_words - gram + 1)
                    one = doc_id.as_py()
                    for h, p in zip(grams[at].view(np.int64).tolist(), at.tolist()):
                        yield h, one, p

        yield from flushed(rows(), schema, limit=4 << 20)

    return docs.mapInArrow(run, f"hash bigint, doc_id {kind.simpleString()}, pos int")


def least_at(grams: np.ndarray, window: int) -> np.ndarray:
    """For every window of ``window`` grams the position of its least gram, the first of equal ones."""
    def first(a, b):
        return np.where(grams[a] <= grams[b], a, b)

    return _sliding(np.arange(len(grams)), window, first)


def _suffix_rows(docs: DataFrame, shared, min_words: int, gram: int) -> DataFrame:
    """(ahead, behind, doc_id, pos) of the anchors whose gram the bit table may hold.

    ``ahead`` holds the words from the anchor on, ``behind`` those before it, backwards; both reach as far as the windows
    do whose first least gram the anchor is. Every word ends with a space, so bytes sort as words do and a common
    beginning of words is one of bytes.
    """
    kind = docs.schema["doc_id"].dataType

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        bits = np.frombuffer(shared.value, np.uint8)
        schema = pa.schema([
            ("ahead", pa.binary()), ("behind", pa.binary()), ("doc_id", to_arrow_type(kind)), ("pos", pa.int32()),
        ])

        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0), batch.column(1)):
                    body = text.as_py()
                    hashes = word_hashes(body)
                    if len(hashes) < min_words:
                        continue
                    grams = runs(hashes, gram)
                    least = least_at(grams, min_words - gram + 1)
                    firsts = np.flatnonzero(np.diff(least, prepend=-1))  # an anchor's windows follow each other
                    lasts = np.append(firsts[1:], len(least)) - 1
                    held = in_table(bits, grams[least[firsts]])
                    if not held.any():
                        continue
                    words, one = [w + b" " for w in body.encode().translate(_LOWER).split()], doc_id.as_py()
                    for s, e in zip(firsts[held].tolist(), lasts[held].tolist()):
                        p = int(least[s])
                        yield b"".join(words[p: e + min_words]), b"".join(words[s:p][::-1]), one, p

        yield from flushed(rows(), schema, weigh=lambda r: 40 + len(r[0]) + len(r[1]))

    return docs.mapInArrow(run, f"ahead binary, behind binary, doc_id {kind.simpleString()}, pos int")


def common_words(a: bytes, b: bytes) -> int:
    """How many words two texts, each of whose words ends with a space, have in common at their beginning."""
    size = min(len(a), len(b))
    if a[:size] != b[:size]:
        differ = int.from_bytes(a[:size], "big") ^ int.from_bytes(b[:size], "big")
        size -= (differ.bit_length() + 7) // 8
    return a.count(b" ", 0, size)


def extended(row: tuple, other: tuple) -> tuple[int, int]:
    """How many words two suffixes share before the anchor and from it on."""
    return common_words(row[1], other[1]), common_words(row[0], other[0])


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` word hashes, as differences of one running sum."""
    powers, inverse = powers_to(len(hashes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers[: len(hashes)], dtype=np.uint64)])
    return mixed((sums[size:] - sums[:-size]) * inverse[: len(hashes) - size + 1])


def _shared_windows(ordered: DataFrame, min_words: int) -> DataFrame:
    """(hash, doc_id, pos, compared) of windows that two documents may share, from suffixes in sorted partitions.

    Each suffix is compared, word by word, with the nearest one before and after it that lies in another document, and
    the match is extended backward from the anchor. No other document's suffix has more words ahead in common with it
    than these two, so windows that reach beyond are in no other document and go. ``compared`` is true for a window that
    lies in a match with a neighbour. The rest may be shared with a document that is no neighbour, whose words before
    the anchor are the same. Suffixes at a partition's border, with a neighbour in another partition, keep all their
    windows, and so do those of a document that fills more than RUN rows on end.
    """
    kind = ordered.schema["doc_id"].dataType

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        schema = pa.schema([
            ("hash", pa.int64()), ("doc_id", to_arrow_type(kind)), ("pos", pa.int32()), ("compared", pa.bool_()),
        ])

        def settled(rows, before, after):
            """(row, offsets of its windows: first, last; offsets compared: first, last) of one document's rows on end."""
            for row in rows:
                ahead, behind = row[0].count(b" "), row[1].count(b" ")
                reach, sure = 0, (1, 0)
                for near in (before, after):
                    if near is None:
                        reach = ahead
                        continue
                    left, right = extended(row, near)
                    reach = max(reach, right)
                    if left + right - min_words > sure[1] - sure[0]:
                        sure = (min_words - right, left)
                if min_words - reach <= behind:
                    yield row, min_words - reach, behind, *sure

        def judged():
            before, rows = None, []
            for batch in batches:
                for row in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                    if rows and row[2] != rows[0][2]:
                        yield from settled(rows, before, row)
                        before, rows = rows[-1], []
                    elif len(rows) >= RUN:
                        yield from settled(rows, before, None)
                        rows = []
                    rows.append(row)
            yield from settled(rows, before, None)

        def together(held):
            texts, docs, starts, sure, base = [], [], [], [], 0
            at = []
            for (ahead, behind, doc_id, pos), first, last, low, high in held:
                back = behind.split()
                texts += [*back[::-1], ahead]
                offsets = np.arange(first, last + 1)
                at.append(base + len(back) - offsets)
                starts.append(pos - offsets)
                sure.append((offsets >= low) & (offsets <= high))
                docs += [doc_id] * len(offsets)
                base += len(back) + ahead.count(b" ")
            hashes = run_hashes(word_hashes(b" ".join(texts)), min_words)
            columns = [
                pa.array(hashes[np.concatenate(at)].view(np.int64)), pa.array(docs, schema.field(1).type),
                pa.array(np.concatenate(starts).astype(np.int32)), pa.array(np.concatenate(sure)),
            ]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        held, size = [], 0
        for one in judged():
            held.append(one)
            size += len(one[0][0]) + len(one[0][1])
            if size >= SUFFIX_BYTES:
                yield together(held)
                held, size = [], 0
        if held:
            yield together(held)

    return ordered.mapInArrow(run, f"hash bigint, doc_id {kind.simpleString()}, pos int, compared boolean")


def repeated_spans(
    docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, start_word, end_word (exclusive), n_words, other_doc_id, later, compared: what repeats in another document.

    A suffix is kept at every position whose ten-word gram hashes lowest in some window of ``min_words`` words; a window
    that is shared has that gram shared as well. Anchors whose gram lies in a single document go, but for a few that a
    bit table of 8 MB lets through. The others' suffixes are sorted as a whole, range partitioned by their words, then
    the identifier, so that a passage that a third of all documents share is spread out. Each is compared with its
    neighbours of other documents and the match is extended to both sides (:func:`_shared_windows`). That settles which
    windows can be shared at all; what is left is grouped by the window's hash, of 64 bits, over all documents: a suffix
    whose neighbours share other words may share a window with a farther one, and ``later`` depends on all holders. The
    smallest and the largest identifier of each group are partial aggregates, so no group is in one task. Overlapping
    windows of a document are laid together, apart for the two values of ``later``, so a span ends where the match ends.

    Every window of ``min_words`` words that two documents hold is found, so every passage of that length or more is,
    whatever stands around it. ``later`` is true where a document of smaller identifier has the window too, whichever of
    all documents that is. The first document of a window is never later by it, so after removing the later spans
    (:func:`without_repeats`) every word cut still stands, within such a window, in a document of smaller identifier.
    ``other_doc_id`` is the smallest identifier that holds a window of a later span; of other spans, whose document
    itself is the smallest, the smallest over the windows of the largest identifier that holds each. ``compared`` is true
    if some window of the span was found by comparing its words with a neighbour's, false if by the groups alone; it
    depends on where the partitions' borders fall. Words are compared with A-Z in lower case; repeats inside one
    document only are not reported.

    Null and short texts have no passages; rows with a null identifier are left out, as no result could name them;
    rows with equal identifiers count as one document. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col).where("doc_id is not null")
    found = _anchor_rows(texts, min_words, gram)
    twice = found.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low <> high")
    shared = spark.sparkContext.broadcast(bit_table(twice, "hash"))  # fixed size
    scratch = Scratch(spark)
    suffixes = scratch.stored(_suffix_rows(texts, shared, min_words, gram))
    shared.destroy()
    order = ["ahead", "doc_id", "pos"]
    ordered = suffixes.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    windows = scratch.stored(_shared_windows(ordered.select("ahead", "behind", "doc_id", "pos"), min_words))
    held = windows.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    # stored, so that the join reads both sides as they were dealt out and Spark can split the rows of a hot window
    held = scratch.stored(held.where("low <> high"))
    later = F.col("doc_id") > F.col("low")
    spans = windows.join(held, "hash").select(
        "doc_id", later.alias("later"), F.col("pos").alias("start"), (F.col("pos") + min_words).alias("end"),
        F.when(later, F.col("low")).otherwise(F.col("high")).alias("other"), "compared",
    )
    group = ["doc_id", "later"]
    line = Window.partitionBy(*group).orderBy("start")
    islands = spans.withColumn(
        "fresh", F.coalesce(F.col("start") > F.lag("end").over(line), F.lit(True)).cast("int")
    ).withColumn("island", F.sum("fresh").over(line))
    return scratch.finished(islands.groupBy(*group, "island").agg(
        F.min("start").alias("start_word"), F.max("end").alias("end_word"), F.min("other").alias("other_doc_id"),
        F.bool_or("compared").alias("compared"),
    ).select(
        "doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"), "other_doc_id",
        "later", "compared",
    ))


def without_repeats(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text with the later spans cut out; documents without such spans are unchanged, null texts stay null."""
    kind = docs.schema[id_col].dataType
    cuts = spans.where("later").groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("start_word", "end_word"))).alias("cuts")
    )
    joined = id_and_text(docs, id_col, text_col, null=None).join(cuts, "doc_id", "left").select("doc_id", "text", "cuts")

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        schema = pa.schema([("doc_id", to_arrow_type(kind)), ("text", pa.string())])

        def rows():
            for batch in batches:
                for doc_id, text, cuts in zip(*[batch.column(i) for i in range(3)]):
                    body, cuts = text.as_py(), cuts.as_py()
                    if cuts and body is not None:
                        words, parts, at = [m.span() for m in _WORD.finditer(body)], [], 0
                        for cut in cuts:
                            first, last = cut["start_word"], min(cut["end_word"], len(words))
                            if first < last:
                                parts.append(body[at: words[first][0]])
                                at = max(at, words[last - 1][1])
                        body = "".join(parts) + body[at:]
                    yield doc_id.as_py(), body

        yield from flushed(rows(), schema, weigh=lambda r: 64 + len(r[1] or ""))

    return joined.mapInArrow(run, f"doc_id {kind.simpleString()}, text string")
