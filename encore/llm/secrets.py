"""Secrets, judged by how many repositories and owners in the corpus hold the same value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.spans import joined, none_over, sha_of_spans, spans_of
from encore.session import cut_lineage

KINDS = ("assign", "access", "hex", "token")
_VALUE = r"[A-Za-z0-9+/_.=-]+"
_ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
PATTERNS = {
    "assign": _ASSIGN + _VALUE,
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "token": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}",
}
MIN_COPIED_OWNERS = 3
MIN_COPIED_REPOSITORIES = 20
MIN_ENTROPY = 2.9  # bits a character; eight characters that differ have 3
# words that mark a value as a stand-in
PLACEHOLDERS = r"(?i)example|sample|changeme|placeholder|your[_-]|dummy"


def _structs(kind_no: int, spans: Column, value) -> Column:
    return F.transform(spans, lambda s: F.struct(
        F.lit(kind_no).alias("kind_no"), s["start"].alias("start"), s["end"].alias("end"), value(s).alias("value")
    ))


def entropy(value: Column) -> Column:
    """Shannon's entropy of the characters, in bits a character; 0 for an empty value."""
    size = F.length(value)
    shares = F.transform(
        F.filter(F.array_distinct(F.split(value, "")), lambda c: c != ""),
        lambda c: (size - F.length(F.replace(value, c, F.lit("")))) / size,
    )
    return F.aggregate(shares, F.lit(0.0), lambda acc, p: acc - p * F.log2(p))


def stepping(value: Column) -> Column:
    """Share of the characters that follow their forerunner in the order of codes, as in 123456 or abcdef."""
    codes = F.transform(F.filter(F.split(value, ""), lambda c: c != ""), F.ascii)
    steps = F.zip_with(F.slice(codes, F.lit(2), F.size(codes)), codes, lambda b, a: (b - a == 1).cast("int"))
    return F.aggregate(F.filter(steps, lambda x: x == 1), F.lit(0), lambda acc, x: acc + x) / F.greatest(F.size(codes), F.lit(1))


def live_looking(value: Column) -> Column:
    """Characters as varied as chance makes them, not mostly one after another, and no word that marks a stand-in."""
    return (entropy(value) >= MIN_ENTROPY) & (stepping(value) < 0.5) & ~value.rlike(PLACEHOLDERS)


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str = "doc_id",
    min_copied_owners: int = MIN_COPIED_OWNERS,
    min_copied_repositories: int = MIN_COPIED_REPOSITORIES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id and spans, array<struct<kind_no, start, end, repositories, owners, verdict>>.

    Candidates are the fixed kinds assign, access and hex, and further long runs of letters, digits and signs that
    hold both a letter and a digit and touch none of them (token). Their values' hashes are counted over the whole
    corpus: distinct repositories (here documents) and distinct owners (here sources). ``verdict`` is ``copied`` from
    ``min_copied_owners`` owners on or from ``min_copied_repositories`` repositories on, even of one owner, as nobody
    spreads a live credential that far; ``live`` for a live-looking value of a single owner in fewer repositories; else
    ``unclear``. Spans of the fixed kinds always stay; a token stays only if it is live.

    A value is counted per repository first, then per owner, then as a whole, each with partial sums, so that a value
    that a third of all rows hold is reduced before it moves; the join that brings the counts back is one that Spark
    can split. Only hashes and positions move, no texts.

    A null text counts as empty; null owners are one owner and null repositories one repository of each owner; a
    repeated row counts once if its repository is named; a null identifier stays null; an empty table gives no rows;
    other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.col(owner_col).cast("string").alias("owner"),
        F.col(repository_col).cast("string").alias("repository"),
    )
    text = F.col("text")
    assign = F.transform(spans_of(text, PATTERNS["assign"]), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"),
        F.regexp_extract(s["match"], f"^{_ASSIGN}({_VALUE})$", 1).alias("match"),
    ))
    found = rows.select(
        "doc_id", "owner", "repository",
        F.filter(assign, lambda s: F.length(s["match"]) >= 6).alias("assign"),
        spans_of(text, PATTERNS["access"]).alias("access"), spans_of(text, PATTERNS["hex"]).alias("hex"),
        F.filter(
            spans_of(text, PATTERNS["token"]), lambda s: s["match"].rlike("[0-9]") & s["match"].rlike("[A-Za-z]")
        ).alias("token"),
    )
    loose = F.filter("token", lambda t: reduce(
        lambda a, b: a & b, [none_over(F.col(k), t["start"], t["end"]) for k in KINDS[:-1]]
    ))
    spans = F.concat(*[
        _structs(i, loose if k == "token" else F.col(k), lambda s: s["match"]) for i, k in enumerate(KINDS)
    ])
    hashed = F.transform(spans, lambda s: F.struct(
        s["kind_no"], s["start"], s["end"], F.sha2(s["value"], 256).alias("hash"), live_looking(s["value"]).alias("live")
    ))
    slim = cut_lineage(
        found.select("doc_id", "owner", "repository", hashed.alias("spans"))
        .withColumn("_row", F.monotonically_increasing_id())
    )
    each = slim.select("_row", "owner", "repository", F.explode("spans").alias("s")).select(
        "_row", "owner", "repository", "s.*"
    )
    owned = each.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one")).groupBy("hash", "owner").agg(
        F.count(F.lit(1)).alias("repositories")
    )
    counts = owned.groupBy("hash").agg(
        F.sum("repositories").alias("repositories"), F.count(F.lit(1)).alias("owners")
    )
    verdict = (
        F.when(
            (F.col("owners") >= min_copied_owners) | (F.col("repositories") >= min_copied_repositories), "copied"
        )
        .when((F.col("owners") == 1) & F.col("live"), "live")
        .otherwise("unclear")
    )
    judged = each.join(counts, "hash").withColumn("verdict", verdict).where(
        (F.col("kind_no") < len(KINDS) - 1) | (F.col("verdict") == "live")
    )
    gathered = judged.groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind_no", "end", "repositories", "owners", "verdict")))
        .alias("spans")
    )
    empty = F.array().cast("array<struct<start:int,kind_no:int,end:int,repositories:bigint,owners:bigint,verdict:string>>")
    return slim.select("_row", "doc_id").join(gathered, "_row", "left").select(
        "doc_id", F.coalesce("spans", empty).alias("spans")
    )


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns from what :func:`find_secrets` returns."""
    base = F.filter("spans", lambda s: s["kind_no"] < len(KINDS) - 1)

    def count(field, value):
        return F.size(F.filter("spans", lambda s: s[field] == value)).cast("bigint")

    return found.select(
        "doc_id",
        *[count("kind_no", i).alias(f"n_{k}") for i, k in enumerate(KINDS[:-1])],
        sha_of_spans(base, KINDS).alias("base_sha256"),
        joined(F.col("spans"), KINDS).alias("spans"),
        count("verdict", "live").alias("n_live"),
        count("verdict", "copied").alias("n_copied"),
    )
