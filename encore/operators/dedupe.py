"""Entity resolution: candidates, fuzzy scores, and the choice of one master per group.

Rows with equal match keys are one node, however many there are, so a hot name is compared once.

Two texts can only reach the threshold if they share character pairs; each text therefore looks up
the other texts by its rarest pairs only, as many of them as the threshold leaves free to differ.
That loses no match (see ``_required``) and skips the common pairs.

Nodes are settled in id order in chunks that double in size. The masters of a chunk claim their
duplicates among all later nodes before the next chunk is compared. A large family of near copies is
therefore compared with its master and not pair by pair: only its few members in the first chunk
meet each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.text import fuzzy_similarity, match_key
from encore.operators.ordering import global_position
from encore.session import cut_lineage

# fixed values: thresholds per data type
THRESHOLDS = {"artists": 0.85, "venues": 0.80}
FIRST_CHUNK = 1000


def _grams(text: Column) -> Column:
    """Character pairs of a text, numbered so that a repeated pair counts as often as it occurs."""
    pairs = F.when(
        F.length(text) < 2, F.array(text)
    ).otherwise(F.transform(F.sequence(F.lit(1), F.length(text) - 1), lambda i: F.substring(text, i, F.lit(2))))
    return _numbered(pairs)


def _word_grams(text: Column) -> Column:
    """Character pairs inside the words of a text; a one-letter word stands for itself."""
    def inside(word: Column) -> Column:
        return F.when(F.length(word) < 2, F.array(word)).otherwise(
            F.transform(F.sequence(F.lit(1), F.length(word) - 1), lambda i: F.substring(word, i, F.lit(2)))
        )
    words = F.split(text, " ")
    return _numbered(F.flatten(F.transform(words, inside)))


def _numbered(items: Column) -> Column:
    return F.transform(
        items,
        lambda x, i: F.concat(x, F.lit("#"), F.size(F.filter(F.slice(items, F.lit(1), i + 1), lambda y: y == x))),
    )


def _required(channel: str, text: Column, threshold: float) -> Column:
    """Pairs two texts must share at least if they match.

    Write t for the threshold, m for the length of one text, w for that of its counterpart and L for
    the common subsequence; a match means L >= t(m + w)/2. Every unmatched character breaks at most
    one run of matches, so at least 3L - m - w - 1 >= (1.5t - 1)(m + w) - 1 pairs stay. The stretch
    compared with a shorter text has w >= tm/(2 - t). Comparing words in another order loses the two
    pairs at each blank; comparing shared words only needs words of total length tm/(2 - t).
    """
    t = threshold - 0.005  # scores are rounded to whole percents
    length = F.length(text)
    small = t / (2 - t)
    if channel == "text":
        need = length * ((1.5 * t - 1) * (1 + small)) - 1
    else:
        words = F.split(text, " ")
        length = F.length(F.array_join(F.array_distinct(words), " "))
        blanks = F.size(words) - 1
        ordered = length * ((1.5 * t - 1) * (1 + small)) - 1 - 2 * blanks
        subset = length * small - 2 * blanks - 1
        need = F.least(ordered, subset)
    return F.greatest(F.ceil(need), F.lit(1)).cast("int")


class KeyIndex:
    """Lookup lists of the distinct texts of one match column."""

    def __init__(self, keys: DataFrame, threshold: float):
        if threshold <= 0.7:
            raise ValueError("the candidate search needs a threshold over 0.7")
        self.threshold = threshold
        text = F.col("key")
        listed = keys.select("key").filter(text != "").distinct().select(
            "key",
            F.inline(
                F.array(
                    F.struct(F.lit("t").alias("channel"), _grams(text).alias("grams"),
                             _required("text", text, threshold).alias("need")),
                    F.struct(F.lit("w").alias("channel"), _word_grams(text).alias("grams"),
                             _required("words", text, threshold).alias("need")),
                )
            ),
        )
        postings = listed.select(
            "key", "channel", "need", F.greatest(F.size("grams") - F.col("need") + 1, F.lit(1)).alias("looked_up"),
            F.explode("grams").alias("gram"),
        )
        # at most a few hundred rows per alphabet: one per pair of characters
        spread = postings.groupBy("channel", "gram").agg(F.count(F.lit(1)).alias("spread"))
        # the grams of one text are few, so they are ordered inside its own row
        ranked = postings.join(spread, ["channel", "gram"]).groupBy(
            "key", "channel", "need", "looked_up"
        ).agg(
            F.array_sort(F.collect_list(F.struct("spread", "gram"))).alias("rarest")
        )
        self.entries = cut_lineage(ranked.select(
            "key", "channel", "need",
            F.transform(F.slice("rarest", F.lit(1), F.col("looked_up")), lambda g: g["gram"]).alias("lookups"),
            F.transform("rarest", lambda g: g["gram"]).alias("grams"),
        ))

    def _lists(self, keys: DataFrame, column: str) -> DataFrame:
        """key, gram, channel, need, and how many of the text's pairs are at the gram's place or behind it."""
        chosen = self.entries.join(keys.select("key").distinct(), "key", "left_semi")
        out = chosen.select("key", "channel", "need", F.size("grams").alias("of"), F.posexplode(column).alias("at", "gram"))
        out = out.select("key", "gram", "channel", "need", (F.col("of") - F.col("at")).alias("left"))
        if column == "grams":
            # a one-letter text matches every text with that letter in it
            letters = chosen.filter(F.col("channel") == "t").select(
                "key", "need", F.explode(F.array_distinct(F.split("key", ""))).alias("letter")
            )
            out = out.unionByName(letters.select(
                "key", F.concat("letter", F.lit("#1")).alias("gram"), F.lit("t").alias("channel"), "need", F.lit(1).alias("left")
            ))
        return out

    def candidates(self, left: DataFrame, right: DataFrame | None = None) -> DataFrame:
        """Pairs (a, b) that can be over the threshold.

        Positional filter: the first pair of characters in common, in the order from the rarest on, leaves both texts
        enough others to reach what the text that seeks requires. Count filter: so many they really share. One-letter
        texts, whose only pair is the letter, are left out of the count.
        """
        same = right is None
        right = left if same else right

        def meet(seekers: DataFrame, others: DataFrame, seeker: str, other: str) -> DataFrame:
            looked = self._lists(seekers, "lookups").withColumnRenamed("key", seeker)
            listed = self._lists(others, "grams").drop("need").withColumnsRenamed({"key": other, "left": "behind"})
            enough = F.least("left", "behind") >= F.col("need")
            return looked.join(listed, ["channel", "gram"]).filter(enough).select("a", "b", "channel")

        pairs = meet(left, right, "a", "b").filter(F.col("a") != F.col("b"))
        if same:
            pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "channel")
        else:
            pairs = pairs.unionByName(meet(right, left, "b", "a").filter(F.col("a") != F.col("b")))
        pairs = pairs.distinct()
        for side in "ab":
            pairs = pairs.join(self.entries.select(
                F.col("key").alias(side), "channel", F.col("grams").alias(f"grams_{side}"), F.col("need").alias(f"need_{side}")
            ), [side, "channel"])
        shared = F.size(F.array_intersect("grams_a", "grams_b"))
        short = F.least(F.length("a"), F.length("b")) == 1
        return pairs.filter(short | (shared >= F.least("need_a", "need_b"))).select("a", "b").distinct()

    def matches(self, left: DataFrame, right: DataFrame | None = None) -> DataFrame:
        """Pairs (a, b, score) over the threshold, a from ``left`` and b from ``right`` (or both from left)."""
        return _scored(self.candidates(left, right), self.threshold)


def _scored(pairs: DataFrame, threshold: float) -> DataFrame:
    return pairs.withColumn("score", fuzzy_similarity("a", "b")).filter(F.col("score") >= threshold)


def find_duplicates(
    df: DataFrame, match_columns: Sequence[str], id_column: str, threshold: float, first_chunk: int = FIRST_CHUNK
) -> DataFrame:
    """(duplicate_id, master_id, similarity_score, match_columns), one row per duplicate.

    In id order, a row no earlier master claims is a master and claims all later rows matching it on
    any of the columns. Matches of a duplicate are not followed further. Null texts match nothing.
    """
    columns = [c for c in match_columns if c in df.columns]
    names = [f"_key{i}" for i in range(len(columns))]
    rows = df.select(
        F.col(id_column).alias("_id"),
        *[F.coalesce(match_key(F.col(c)), F.lit("")).alias(k) for c, k in zip(columns, names)],
    )
    # a row without any text matches nothing, its likes included
    rows = rows.filter(F.concat(*[F.col(k) for k in names]) != "")
    # rows with the same keys behave alike: they form one node, led by their smallest id
    nodes = global_position(rows.groupBy(*names).agg(F.min("_id").alias("lead")), [F.col("lead")], "place")
    settled = _settle(nodes, names, threshold, first_chunk)
    members = rows.join(settled, names).filter(F.col("_id") != F.col("master"))
    master_keys = nodes.select(F.col("lead").alias("master"), *[F.col(k).alias(f"m{k}") for k in names])
    # scored once per node, not per row
    score = F.greatest(*[fuzzy_similarity(k, f"m{k}") for k in names], F.lit(0.0))
    scores = settled.join(master_keys, "master").select(*names, score.alias("similarity_score"))
    return members.join(scores, names).select(
        F.col("_id").alias("duplicate_id"),
        F.col("master").alias("master_id"),
        "similarity_score",
        F.array(*[F.lit(c) for c in match_columns]).alias("match_columns"),
    )


def _key(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.col(name).alias("key"))


def _settle(nodes: DataFrame, names: Sequence[str], threshold: float, first_chunk: int) -> DataFrame:
    """The master of every node, chunk by chunk in id order."""
    total = nodes.count()
    indexes = [KeyIndex(_key(nodes, name), threshold) for name in names]
    remaining, done, low, size = nodes, None, 0, first_chunk
    while low < total:
        high = low + size
        chunk = remaining.filter(F.col("place") <= high)
        settled = _choose_masters(chunk.select(*names, "lead"), indexes, names)
        if high < total:
            masters = settled.join(nodes.select(*names, "lead"), names).filter(F.col("master") == F.col("lead"))
            later = remaining.filter(F.col("place") > high)
            claimed = cut_lineage(_claims(masters, later, indexes, names))
            settled = settled.unionByName(claimed)
            remaining = cut_lineage(later.join(claimed, names, "left_anti"))
        done = settled if done is None else done.unionByName(settled)
        if high < total and remaining.isEmpty():
            break
        low, size = high, size * 2
    return done


def _claims(masters: DataFrame, later: DataFrame, indexes: Sequence[KeyIndex], names: Sequence[str]) -> DataFrame:
    """Later nodes that match a master on some column, each with its smallest such master."""
    claimed = None
    for index, name in zip(indexes, names):
        by_key = masters.filter(F.col(name) != "").groupBy(F.col(name).alias("a")).agg(F.min("lead").alias("master"))
        found = index.matches(_key(masters, name), _key(later, name)).join(by_key, "a").select("b", "master")
        best = found.unionByName(by_key.withColumnRenamed("a", "b")).groupBy("b").agg(F.min("master").alias("master"))
        one = later.join(best.withColumnRenamed("b", name), name).select(*names, "master")
        claimed = one if claimed is None else claimed.unionByName(one)
    return claimed.groupBy(*names).agg(F.min("master").alias("master"))


def _choose_masters(nodes: DataFrame, indexes: Sequence[KeyIndex], names: Sequence[str]) -> DataFrame:
    """The master of every node of a chunk: itself, or the smallest master adjacent to it.

    Rounds: an undecided node next to a master is a duplicate; an undecided node smaller than all
    undecided nodes next to it is a master. Neighbours are seen through the keys: per key the
    smallest master and the smallest undecided node, then the same over the matched keys. So a key
    shared by many nodes costs one row and not one per pair.
    """
    edges = None
    for i, (index, name) in enumerate(zip(indexes, names)):
        pairs = index.matches(_key(nodes, name))
        both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        one = both.select(F.lit(i).alias("slot"), "a", "b")
        edges = one if edges is None else edges.unionByName(one)
    edges = cut_lineage(edges)
    state = nodes.withColumn("role", F.lit("open"))
    while True:  # every round settles at least the smallest open node
        seen = _around(state, edges, names)
        undecided = F.col("role") == "open"
        role = (
            F.when(undecided & F.col("near_master").isNotNull(), "duplicate")
            .when(undecided & (F.col("lead") <= F.col("near_open")), "master")
            .otherwise(F.col("role"))
        )
        state = cut_lineage(seen.withColumn("role", role).select(*names, "lead", "role"))
        if state.filter(F.col("role") == "open").isEmpty():
            # only now are all masters known, so only now the smallest one next to a duplicate
            own = F.when(F.col("role") == "master", F.col("lead")).otherwise(F.col("near_master"))
            return cut_lineage(_around(state, edges, names).select(*names, own.alias("master")))


def _around(state: DataFrame, edges: DataFrame, names: Sequence[str]) -> DataFrame:
    """Smallest master and smallest undecided node next to each node, itself included."""
    out = state
    for i, key in enumerate(names):
        own = state.filter(F.col(key) != "").groupBy(F.col(key).alias("k")).agg(
            F.min(F.when(F.col("role") == "master", F.col("lead"))).alias("m"),
            F.min(F.when(F.col("role") == "open", F.col("lead"))).alias("o"),
        )
        slot = edges.filter(F.col("slot") == i)
        passed = slot.join(own, slot.b == own.k).select(F.col("a").alias("k"), "m", "o")
        near = own.unionByName(passed).groupBy("k").agg(F.min("m").alias(f"m{i}"), F.min("o").alias(f"o{i}"))
        out = out.join(near.withColumnRenamed("k", key), key, "left")
    masters = [F.col(f"m{i}") for i in range(len(names))]
    opens = [F.col(f"o{i}") for i in range(len(names))]
    # nodes whose keys are all blank have no neighbours but themselves
    return out.withColumn("near_master", F.least(*masters) if len(masters) > 1 else masters[0]).withColumn(
        "near_open", F.coalesce(F.least(*opens) if len(opens) > 1 else opens[0], F.col("lead"))
    )


def deduplicate(
    df: DataFrame, match_columns: Sequence[str], id_column: str, threshold: float
) -> tuple[DataFrame, DataFrame]:
    """The table without its duplicates, and the duplicates with their masters."""
    duplicates = cut_lineage(find_duplicates(df, match_columns, id_column, threshold))
    kept = df.join(duplicates.select(F.col("duplicate_id").alias(id_column)), id_column, "left_anti")
    return kept, duplicates


def duplicate_metrics(df: DataFrame, duplicates: DataFrame, data_type: str) -> DataFrame:
    """(metric, value): number of duplicates and their percent of all rows."""
    counts = duplicates.agg(F.count(F.lit(1)).alias("d"))
    total = df.agg(F.count(F.lit(1)).alias("t"))
    share = F.col("d") / F.nullif(total.scalar(), F.lit(0)) * 100
    rows = counts.select(F.col("d").cast("double").alias("d"), F.coalesce(share, F.lit(0.0)).alias("p"))
    return rows.select(
        F.inline(
            F.array(
                F.struct(F.lit(f"{data_type}_duplicate_count").alias("metric"), F.col("d").alias("value")),
                F.struct(F.lit(f"{data_type}_duplicate_percentage").alias("metric"), F.col("p").alias("value")),
            )
        )
    )
