"""Personal data: base patterns, and contextual extraction bootstrapped from what they find."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import id_and_text
from encore.llm.spans import joined, none_over, sha_of_spans, spans_of
from encore.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
UNIT = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
CONTEXT_CHARS = 64
CONTEXT_WORDS = 2
ROUNDS = 3
MIN_SUPPORT = 5
MIN_CONFIDENCE = 0.8


def luhn(digits: Column) -> Column:
    """True if the digits of a string pass Luhn's check."""
    size = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), size),
        F.lit(0),
        lambda acc, i: acc + F.when(
            (size - i) % 2 == 1,
            F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                         F.substring(digits, i, F.lit(1)).cast("int") + 1),
        ).otherwise(F.substring(digits, i, F.lit(1)).cast("int")),
    )
    return total % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """The contract's spans by kind, as array<struct<start, end, match, left>>."""
    found = {kind: spans_of(text, PATTERNS[kind], CONTEXT_CHARS) for kind in KINDS}
    low = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    digits = lambda x: F.regexp_replace(x["match"], "[^0-9]", "")
    found["ip"] = F.filter(found["ip"], lambda x: x["match"].rlike(rf"^{low}(?:\.{low}){{3}}$"))
    found["card"] = F.filter(found["card"], lambda x: luhn(digits(x)))
    found["phone"] = F.filter(found["phone"], lambda x: F.length(digits(x)).between(9, 15))
    return found


def _pattern(left: Column) -> Column:
    """The last two words of the text before, in lower case, without marks at their ends."""
    words = F.filter(F.split(F.lower(left), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    trimmed = F.transform(words, lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    kept = F.filter(trimmed, lambda w: w != "")
    return F.concat_ws(" ", F.slice(kept, F.greatest(F.size(kept) - CONTEXT_WORDS + 1, F.lit(1)), CONTEXT_WORDS))


def bootstrap(
    edges: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """Patterns (pattern, kind, confidence) learned from a graph of pattern, instance and seed (the kind or null).

    Seeds start at 1 for their kind. In every round a pattern's confidence for a kind is the mean of its distinct
    instances' confidences, 0 if fewer than ``min_support`` of them stand at a half or more; an instance that is no
    seed then gets one minus the product of its patterns' doubts. Edges are distinct, scores are one row per key, so
    a hot pattern or instance is summed before it moves, and the joins are ones that Spark can split.
    """
    edges = cut_lineage(edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")))
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"))
    seeds = edges.where("seed is not null").groupBy("instance").agg(F.max("seed").alias("kind"))
    scores = seeds.select("instance", "kind", F.lit(1.0).alias("score"))
    patterns = None
    for _ in range(rounds):
        mass = edges.select("pattern", "instance").join(scores, "instance").groupBy("pattern", "kind").agg(
            F.sum("score").alias("mass"), F.count_if(F.col("score") >= 0.5).alias("support")
        )
        patterns = cut_lineage(
            mass.where(F.col("support") >= min_support).join(sizes, "pattern")
            .select("pattern", "kind", (F.col("mass") / F.col("instances")).alias("confidence"))
        )
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))
        learned = edges.where("seed is null").join(patterns, "pattern").groupBy("instance", "kind").agg(
            (1 - doubt).alias("score")
        )
        known = seeds.select(F.col("instance").alias("_i"))
        scores = learned.join(known, F.col("instance") == F.col("_i"), "left_anti").unionByName(
            seeds.select("instance", "kind", F.lit(1.0).alias("score"))
        )
    best = patterns.groupBy("pattern").agg(
        F.max(F.struct("confidence", "kind")).alias("best")
    )
    return best.select("pattern", "best.kind", "best.confidence").where(F.col("confidence") >= min_confidence)


def find_pii(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = ROUNDS,
    min_support: int = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, base and found, arrays of struct<kind_no, start, end> in code points.

    ``base`` holds the matches of the fixed patterns, kind by kind (:data:`KINDS`). They are the seeds: the two words
    before an identifier are its pattern, and so are those before any word with a digit or an at sign. Patterns and
    instances over the whole corpus are scored by :func:`bootstrap`, and ``found`` has the words that stand after a
    pattern of high confidence and touch no base span, under the kind that the pattern stands for.

    A null text counts as empty and gives no spans; a null identifier stays null; repeated rows each get their spans;
    an empty table gives no rows; other columns are not read. Only spans and contexts of 64 characters are written
    and moved, never texts. A context crosses line ends but not the text's start.
    """
    rows = id_and_text(docs, id_col, text_col)
    text = F.col("text")
    arrays = rows.select("doc_id", "text", *[c.alias(k) for k, c in base_spans(text).items()])

    def seeds_of(kind_no: int, kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(
            F.lit(kind_no).alias("kind_no"), s["start"].alias("start"), s["end"].alias("end"),
            F.lower(s["match"]).alias("instance"), s["left"].alias("left"),
        ))

    seeds = F.concat(*[seeds_of(i, k) for i, k in enumerate(KINDS)])
    others = F.filter(spans_of(text, UNIT, CONTEXT_CHARS), lambda u: reduce(
        lambda a, b: a & b, [none_over(F.col(k), u["start"], u["end"]) for k in KINDS]
    ))
    slim = cut_lineage(
        arrays.select("doc_id", seeds.alias("seeds"), others.alias("units"))
        .withColumn("_row", F.monotonically_increasing_id())
    )
    known = slim.select("_row", F.explode("seeds").alias("s")).select(
        F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("s.kind_no") + 1).alias("seed"),
        F.col("s.instance").alias("instance"), _pattern(F.col("s.left")).alias("pattern"),
    )
    lead = F.length(F.regexp_extract("u.match", r"^[^\p{L}\p{N}@+]*", 0))
    tail = F.length(F.regexp_extract("u.match", r"[^\p{L}\p{N}]*$", 0))
    unknown = slim.select("_row", F.explode("units").alias("u")).select(
        "_row", (F.col("u.start") + lead).alias("start"), (F.col("u.end") - tail).alias("end"),
        F.lower(F.regexp_replace("u.match", r"^[^\p{L}\p{N}@+]*|[^\p{L}\p{N}]*$", "")).alias("instance"),
        _pattern(F.col("u.left")).alias("pattern"),
    ).where((F.col("pattern") != "") & (F.col("start") < F.col("end")))
    edges = known.where("pattern <> ''").unionByName(
        unknown.select(F.lit(None).cast("string").alias("seed"), "instance", "pattern")
    )
    strong = bootstrap(edges, rounds, min_support, min_confidence)
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    found = unknown.join(strong, "pattern").groupBy("_row").agg(
        F.collect_list(F.struct(number.alias("kind_no"), "start", "end")).alias("found")
    )
    base = F.transform("seeds", lambda s: F.struct(s["kind_no"].alias("kind_no"), s["start"].alias("start"), s["end"].alias("end")))
    empty = F.array().cast("array<struct<kind_no:int,start:int,end:int>>")
    return slim.select("_row", "doc_id", base.alias("base")).join(found, "_row", "left").select(
        "doc_id", "base", F.coalesce("found", empty).alias("found")
    )


def digests(spans: DataFrame) -> DataFrame:
    """The contract's columns from what :func:`find_pii` returns."""
    def count(number):
        return F.size(F.filter("base", lambda s: s["kind_no"] == number)).cast("bigint")

    def ordered(column):
        return F.array_sort(F.transform(column, lambda s: F.struct(s["kind_no"], s["start"], s["end"])))

    return spans.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        sha_of_spans(ordered(F.col("base")), KINDS).alias("base_sha256"),
        joined(ordered(F.concat("base", "found")), KINDS).alias("spans"),
        F.size("found").cast("bigint").alias("n_found"),
    )
