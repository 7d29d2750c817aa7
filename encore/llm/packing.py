"""Best-fit packing of token sequences by linear grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.binpacking import GROUPS, make_plan
from encore.llm.common import Scratch, before, flushed, id_and_text, ranged

CAPACITY = 4096
END = 1


def token_pieces(
    docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END, id_col: str = "doc_id",
    text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids: the documents' ids and ``end_id``, cut at ``capacity``.

    Only a document with more ids is cut. ``tokenizer_file`` lies at the same path on every machine; special tokens
    are neither added nor read from the text. A null text counts as empty, which leaves the end alone.
    """
    kind = docs.select(F.col(id_col).alias("doc_id")).schema[0].dataType

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        from encore.llm.wordpiece import word_ids

        encoder = word_ids(tokenizer_file)
        fields = [
            ("doc_id", to_arrow_type(kind)), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
            ("ids_crc32", pa.int64()),
        ]
        schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))
        end = end_id.to_bytes(4, "little")

        def row(doc_id, piece, ids):
            out = (doc_id, piece, piece * capacity, len(ids) // 4, zlib.crc32(ids))
            return (*out, np.frombuffer(ids, "<u4").astype(np.int32)) if with_ids else out

        def rows():
            for batch in batches:
                texts = (text.as_py() for text in batch.column(1))
                for doc_id, blocks in zip(batch.column(0).to_pylist(), encoder.streams(texts)):
                    held, piece = b"", 0
                    for block in blocks:
                        held += block
                        at = 0
                        while len(held) - at > 4 * capacity:
                            yield row(doc_id, piece, held[at:at + 4 * capacity])
                            at += 4 * capacity
                            piece += 1
                        held = held[at:]
                    held += end
                    yield row(doc_id, piece, held[:4 * capacity])
                    if len(held) > 4 * capacity:
                        yield row(doc_id, piece + 1, held[4 * capacity:])

        yield from flushed(rows(), schema, weigh=lambda r: 4 * r[3] if with_ids else 64)

    more = ", ids array<int>" if with_ids else ""
    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {kind.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint{more}"
    )


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` of 1 to ``capacity``.

    Pieces of a length are interchangeable, so the plan is made from the number of pieces of each length, at most
    ``capacity`` numbers, and names places in the order by length; every piece's place comes from a range partitioning
    with the offsets of its partitions. The plan's size is bounded by the lengths and patterns (:mod:`binpacking`).
    """
    spark = pieces.sparkSession
    scratch = Scratch(spark)
    kept = scratch.stored(pieces.withColumn("_row_key", F.monotonically_increasing_id()))
    tally = kept.groupBy("length").count().collect()  # a row per length
    counts = [0] * (capacity + 1)
    for r in tally:
        counts[r["length"]] = r["count"]
    rows = spark.sparkContext.broadcast(make_plan(counts, capacity, groups).rows())
    placed = ranged(kept.select("_row_key", "length"), [F.col("length"), F.col("_row_key")])
    totals = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per range partition
    numbered = placed.join(F.broadcast(before(totals, "_part", {"_rows": "_before"})), "_part").select(
        "_row_key", (F.col("_before") + F.col("_row")).alias("_place")
    )

    def run(batches):
        import numpy as np
        import pyarrow as pa

        plan = rows.value
        for batch in batches:
            place = batch.column(1).to_numpy()
            at = np.searchsorted(plan[:, 0], place, side="right") - 1
            start, per, length, offset, first = plan[at].T
            sequence, nth = np.divmod(place - start, per)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(first + sequence), pa.array(offset + nth * length)],
                names=["_row_key", "sequence_id", "offset"],
            )

    dealt = numbered.mapInArrow(run, "_row_key bigint, sequence_id bigint, offset bigint")
    return scratch.finished(kept.join(dealt, "_row_key").drop("_row_key"))


def pack(
    docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END, id_col: str = "doc_id",
    text_col: str = "text", with_ids: bool = False, groups: int = GROUPS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids if asked for.

    No sequence holds more than ``capacity`` tokens, and its pieces lie in it without gaps. Long pieces are grouped,
    rounded and configured, the others go where they fit best. A null or empty text is a piece of one token; repeated
    rows are packed each, null identifiers stay null; an empty table gives no rows; other columns are not read.
    """
    return place_pieces(token_pieces(docs, tokenizer_file, capacity, end_id, id_col, text_col, with_ids), capacity, groups)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences themselves, from a packing with ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most a capacity of ids
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
