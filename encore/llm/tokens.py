"""Byte-level BPE encoding and decoding with a local rank file."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import flushed, id_and_text

CHUNK = 20_000  # characters that go to the encoder at once, give or take a word
LONG_RUN = 10_000  # white space characters in a row that go to the encoder by themselves
_CUT = re.compile(r"(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")
# the White_Space characters of Unicode, which the split pattern's \s stands for
_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)
_encoders: dict = {}


def encoder(rank_file: str, pattern: str):
    """The encoder of a rank file, once per process."""
    import base64

    import tiktoken

    key = (rank_file, pattern)
    if key not in _encoders:
        ranks = {}
        with open(rank_file, "rb") as lines:
            for line in lines:
                if line.strip():
                    token, rank = line.split()
                    ranks[base64.b64decode(token)] = int(rank)
        _encoders[key] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[key]


def pieces(text: str, size: int = CHUNK) -> Iterator[str]:
    """Cut a long text where every split pattern that binds at most one leading blank to a word cuts as well.

    A cut lies before a blank that stands between an ASCII letter or digit and another one: no match can hold
    the blank and what is before it, and the white space rules see the same characters on both sides.
    """
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def runs_apart(text: str) -> Iterator[tuple[str, bool]]:
    """The text in order, its long runs of white space apart: (part, whether it is one match of the split pattern).

    ``\\s+(?!\\S)`` takes such a run but for its last character, or all of it at the text's end, and the library's
    matcher would go back character by character to find that. No match holds white space behind anything else, and
    none looks back, so that the rest may be matched from the run's last character on.
    """
    start = 0
    for run in _RUN.finditer(text):
        end = run.end() - (run.end() < len(text))
        yield text[start:run.start()], False
        yield text[run.start():end], True
        start = end
    yield text[start:], False


def _ids(tool, text: str, size: int) -> list[int]:
    ids: list[int] = []
    for part, whole in runs_apart(text):
        if whole:
            ids += tool._encode_single_piece(part)
        else:
            for piece in pieces(part, size):
                ids += tool.encode_ordinary(piece)
    return ids


def encode(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", size: int = CHUNK
) -> DataFrame:
    """One row per document: doc_id, ids (array of int), decoded (the bytes that the ids stand for).

    ``rank_file`` lies at the same path on every machine. Special tokens are ordinary text. A null text counts as
    empty and gives no ids; a null identifier stays null; repeated rows are encoded each; an empty table gives no
    rows; other columns are not read. A long text is encoded in pieces that meet at safe boundaries, its long runs of white
    space by themselves. Of one text all ids and bytes are held, as they are one row; a batch of results is sent on
    every 8 MB.
    """
    kind = docs.select(F.col(id_col).alias("doc_id")).schema[0].dataType

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        tool = encoder(rank_file, pattern)
        schema = pa.schema([
            ("doc_id", to_arrow_type(kind)), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary()),
        ])

        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0), batch.column(1)):
                    ids = _ids(tool, text.as_py(), size)
                    yield doc_id.as_py(), ids, tool.decode_bytes(ids)

        yield from flushed(rows(), schema, weigh=lambda r: 4 * len(r[1]) + len(r[2]))

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {kind.simpleString()}, ids array<int>, decoded binary"
    )


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by a blank), decoded_sha256, and columns asked for."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )
