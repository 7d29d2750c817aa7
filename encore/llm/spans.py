"""Spans of regular expressions as columns, in code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns below are written so that Java's matcher neither recurses with the text's length nor starts anew inside
# a run it has already tried; each finds the same matches as the plain pattern of the contract.


CHUNK = 256  # matches whose spans are appended one by one; an append copies what is there


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spans_of(text: Column, pattern: str, left: int = 0) -> Column:
    """All leftmost non-overlapping matches as array<struct<start, end, match[, left]>>, end exclusive.

    The gaps between the matches come from ``split``; their lengths and the matches' add up to the positions. ``left``
    asks for as many characters before each match. Matches are gathered in chunks, and the text is never cut at a
    position, which would count its characters again, so the work of a text grows with its length and its matches.
    """
    fields = "start:int,end:int,match:string" + (",left:string" if left else "")
    none = F.array().cast(f"array<struct<{fields}>>")

    def one(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        before = F.concat(acc["tail"], x["gap"])
        span = [start.alias("start"), end.alias("end"), x["match"].alias("match")]
        if left:
            span.append(F.substring(before, -left, left).alias("left"))
        tail = F.substring(F.concat(before, x["match"]), -left, left) if left else F.lit("")
        return F.struct(
            end.alias("at"), tail.alias("tail"), F.concat(acc["out"], F.array(F.struct(*span))).alias("out")
        )

    def located(pairs):
        def chunk(acc, i):
            start = F.struct(acc["at"].alias("at"), acc["tail"].alias("tail"), none.alias("out"))
            done = F.aggregate(F.slice(pairs, i * CHUNK + 1, F.lit(CHUNK)), start, one)
            return let(done, lambda d: F.struct(
                d["at"].alias("at"), d["tail"].alias("tail"), F.concat(acc["out"], F.array(d["out"])).alias("out")
            ))

        blank = F.struct(
            F.lit(0).alias("at"), F.lit("").alias("tail"), F.array().cast(f"array<array<struct<{fields}>>>").alias("out")
        )
        chunks = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / CHUNK).cast("int"))
        return F.flatten(F.aggregate(chunks, blank, chunk, lambda acc: acc["out"]))

    def zipped(found):
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        # without a match the text is not read a second time
        return F.when(F.size(found) > 0, let(F.arrays_zip(found.alias("match"), gaps.alias("gap")), located)).otherwise(none)

    return let(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), zipped)


def none_over(spans: Column, start: Column, end: Column) -> Column:
    """True if none of the spans, in order and apart from each other, overlaps with start to end; by halving."""
    size = F.size(spans)

    def halve(acc, _):
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        ahead = F.get(spans, middle)["start"] < end
        open_ = acc["low"] < acc["high"]
        return F.struct(
            F.when(open_ & ahead, middle + 1).otherwise(acc["low"]).alias("low"),
            F.when(open_ & ~ahead, middle).otherwise(acc["high"]).alias("high"),
        )

    steps = F.sequence(F.lit(1), F.length(F.bin(size)))  # as many as the number of spans has binary digits
    last = F.aggregate(steps, F.struct(F.lit(0).alias("low"), size.alias("high")), halve, lambda acc: acc["low"]) - 1
    free = let(last, lambda i: (i < 0) | (F.get(spans, i)["end"] <= start))
    return F.when(size > 0, free).otherwise(F.lit(True))


def joined(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of array<struct<kind_no, start, end>>, in the array's order, joined by commas."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind_no"] + 1), s["start"].cast("string"), s["end"].cast("string")
        )),
        ",",
    )


def sha_of_spans(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.sha2(joined(spans, kinds).cast("binary"), 256)
