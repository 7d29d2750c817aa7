"""Packing against the tokenizer itself, plain best fit and awkward texts."""

import bisect
import random
import struct
import zlib

import plain
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from encore.llm import packing, wordpiece
from encore.llm.binpacking import make_plan

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tool():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(FILE)
    made.encode_special_tokens = True
    return made


def plain_pieces(tool, rows, capacity):
    out = []
    for doc_id, text in rows:
        ids = tool.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start:start + capacity]
            out.append((doc_id, piece, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    return sorted(out, key=repr)


def packed_well(rows, capacity):
    """Sequences used, after a check that each is filled without gaps and within the capacity."""
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held)


def best_fit_decreasing(lengths, capacity):
    rooms, used = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        if at == len(rooms):
            used += 1
            bisect.insort(rooms, capacity - length)
        else:
            bisect.insort(rooms, rooms.pop(at) - length)
    return used


@pytest.mark.parametrize("capacity", [4096, 64])
def test_awkward_rows(spark, tool, capacity):
    rows = [(r[0], r[1]) for r in plain.awkward()]
    rows += [(900, "a\x00b \x00 <|endoftext|> <|startoftext|>x"), (901, "Ünï. Codé, ẖ H̱ ΑΣ. İ̇ \x1c\x85\xa0 ａ"), (902, "A.B. c.,d ., ... e. f,")]
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string"), FILE, capacity).collect()
    assert sorted([tuple(r)[:5] for r in got], key=repr) == plain_pieces(tool, rows, capacity)
    packed_well(got, capacity)


def test_given_documents(spark, tool):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = packing.pack(docs, FILE).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted([tuple(r)[:5] for r in got], key=repr) == plain_pieces(tool, rows, 4096)
    lengths = [r["length"] for r in got]
    assert packed_well(got, 4096) <= -(-sum(lengths) // 4096) * 1.01 + 1


def test_ids_come_back(spark, tool):
    rows = [(i, f"word{i} " * (i % 7)) for i in range(60)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string"), FILE, 16, with_ids=True).cache()
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(got).collect()}
    docs = {}
    for r in got.collect():
        part = whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]]
        assert part == r["ids"]
        docs.setdefault(r["doc_id"], []).append((r["start"], part))
    for doc_id, text in rows:
        assert sum((p for _, p in sorted(docs[doc_id])), []) == tool.encode(text, add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("text", [
    " " * 2_000_000, "\n" * 2_000_000, "　" * 300_000, "漢" * 200_000, "x" * 200_000, "a b. " * 300_000, "." * 300_000,
    "<|endoftext|>" * 50_000,
])
def test_very_long_texts(tool, text):
    ids = b"".join(next(iter(wordpiece.word_ids(FILE).streams([text]))))
    assert ids == struct.pack(f"<{len(ids) // 4}I", *tool.encode(text, add_special_tokens=False).ids)


def test_words_are_forgotten(monkeypatch, tool):
    monkeypatch.setattr(wordpiece, "MEMORY", 10)
    monkeypatch.setattr(wordpiece, "BLOCK", 50)
    fresh = wordpiece.WordIds(FILE)
    for text in (" ".join(f"word{i % 23} w{i}" for i in range(400)), "w1 " + "y" * 100 + " w1 " + "y" * 100):
        ids = b"".join(next(iter(fresh.streams([text]))))
        assert ids == struct.pack(f"<{len(ids) // 4}I", *tool.encode(text, add_special_tokens=False).ids)
    assert len(fresh.known) < 120


def test_another_law_is_refused():
    with pytest.raises(ValueError):
        wordpiece.WordIds(public_tokenizers.path("byte_bpe_50k.json"))


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, text string"), FILE).collect() == []


@pytest.mark.parametrize("kind", ["even", "skewed", "halves", "ones", "one length"])
def test_plan_against_best_fit(kind):
    rng = random.Random(kind)
    capacity = 512
    made = {
        "even": lambda: rng.randint(1, 512), "skewed": lambda: min(512, max(1, int(rng.lognormvariate(4, 1.3)))),
        "halves": lambda: rng.randint(140, 262), "ones": lambda: rng.choice([1, 1, 500]), "one length": lambda: 171,
    }[kind]
    lengths = [made() for _ in range(5000)]
    counts = [0] * (capacity + 1)
    for x in lengths:
        counts[x] += 1
    plan = make_plan(counts, capacity, 128)
    rows = plan.rows().tolist()
    place, seen, filled = 0, {}, {}
    ends = [r[0] for r in rows[1:]] + [len(lengths)]
    for (start, per, length, offset, first), end in zip(rows, ends):
        assert start == place
        for i in range(end - start):
            assert sorted(lengths)[start + i] == length if i in (0, end - start - 1) else True
            filled.setdefault(first + i // per, []).append((offset + i % per * length, length))
        place = end
    assert place == len(lengths)
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(filled) <= best_fit_decreasing(lengths, capacity) * 1.02 + 1


def test_plan_does_not_grow_with_the_items():
    rng = random.Random(5)
    sizes = []
    for scale in (1, 1000):
        counts = [0] + [scale * rng.randint(0, 9) for _ in range(512)]
        sizes.append(len(make_plan(counts, 512, 32).rows()))
    assert sizes[1] < 2 * sizes[0] + 4 * 512


def test_clashing_columns(spark):
    rows = [(i, f"some words {i}", "x", 1) for i in range(40)]
    wide = spark.createDataFrame(rows, "doc_id bigint, text string, length string, _row_key int")
    wide = wide.select("*", *[F.lit("x").alias(c) for c in ("piece", "start", "ids_crc32", "sequence_id", "offset", "_part", "_place")])
    key = lambda df: sorted(tuple(r)[:5] for r in df.collect())
    assert key(packing.pack(wide, FILE)) == key(packing.pack(wide.select("doc_id", "text"), FILE))
