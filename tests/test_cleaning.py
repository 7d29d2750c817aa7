"""Normalising, validating, match keys and entity resolution."""

import random

import pytest
from pyspark.sql import functions as F

from encore.functions.text import fuzzy_score, match_key
from encore.operators import dedupe, normalize, validate

AS_OF = "2024-06-01"


def keys(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    return [r[0] for r in df.select(match_key(F.col("name"))).collect()]


def test_match_keys(spark):
    assert keys(spark, ["The Rolling Stones Inc.", "  A  Tribe", "Café   Tacvba!", "Sigur Rós", None]) == [
        "rolling stones", "tribe", "café tacvba", "sigur rós", None]


def test_fuzzy_scores():
    assert fuzzy_score("beatles", "beatles") == 1.0
    assert fuzzy_score("beatles", "the beatles") > 0.8
    assert fuzzy_score("stones rolling", "rolling stones") == 1.0
    assert fuzzy_score("", "x") == 0.0
    assert fuzzy_score("abcdef", "uvwxyz") == 0.0


def names(seed, n):
    rng = random.Random(seed)
    words = ["red", "blue", "old", "new", "hall", "club", "arena", "the", "kings", "queens", "x", "lions", "lion", "zed"]
    out = []
    for _ in range(n):
        name = " ".join(rng.choice(words) for _ in range(rng.randint(1, 3)))
        if rng.random() < 0.5:
            at = rng.randrange(len(name))
            name = name[:at] + rng.choice("abcxyz ") + name[at + rng.randint(0, 1):]
        out.append(name.strip() or None)
    return out


def all_matches(keys, threshold):
    texts = sorted({r["key"] for r in keys.collect() if r["key"]})
    return {(a, b) for i, a in enumerate(texts) for b in texts[i + 1:] if fuzzy_score(a, b) >= threshold}


@pytest.mark.parametrize("threshold", [0.85, 0.80])
def test_candidates_lose_no_match(spark, threshold):
    df = spark.createDataFrame([(n,) for n in names(3, 150)], "name string").select(match_key(F.col("name")).alias("key"))
    index = dedupe.KeyIndex(df.filter("key <> ''"), threshold)
    found = {(r["a"], r["b"]) for r in index.matches(df.filter("key <> ''").distinct()).collect()}
    assert found == all_matches(df, threshold)


def greedy(rows, columns, threshold):
    """The pair loop: an unclaimed row claims every later unclaimed match."""
    claimed = {}
    for i, one in enumerate(rows):
        if one["id"] in claimed:
            continue
        for two in rows[i + 1:]:
            if two["id"] in claimed:
                continue
            score = max(fuzzy_score(one[c], two[c]) for c in columns)
            if score >= threshold:
                claimed[two["id"]] = (one["id"], score)
    return claimed


@pytest.mark.parametrize("columns,first_chunk", [(["name"], 1000), (["name"], 8), (["name", "city"], 1000), (["name", "city"], 5)])
def test_masters_equal_the_pair_loop(spark, columns, first_chunk):
    cities = [None, "york", "yorke", "berlin", "lima", "limas"]
    rng = random.Random(5)
    rows = [(i, n, rng.choice(cities) if rng.random() < 0.3 else f"c{i * 7919}") for i, n in enumerate(names(11, 60))]
    df = spark.createDataFrame(rows, "id int, name string, city string")
    keyed = df.select("id", *[F.coalesce(match_key(F.col(c)), F.lit("")).alias(c) for c in ("name", "city")]).orderBy("id").collect()
    wanted = greedy(keyed, columns, 0.85)
    found = dedupe.find_duplicates(df, columns, "id", 0.85, first_chunk).collect()
    assert {r["duplicate_id"]: (r["master_id"], round(r["similarity_score"], 6)) for r in found} == {
        k: (m, round(s, 6)) for k, (m, s) in wanted.items()}


def test_deduplicate_keeps_masters(spark):
    df = spark.createDataFrame([("1", "The Beatles"), ("2", "Beatles"), ("3", "Queen"), ("4", None), ("5", None)], "id string, name string")
    kept, duplicates = dedupe.deduplicate(df, ["name"], "id", 0.85)
    assert sorted(r["id"] for r in kept.collect()) == ["1", "3", "4", "5"]
    assert [(r["duplicate_id"], r["master_id"]) for r in duplicates.collect()] == [("2", "1")]


def test_normalize_artists(spark):
    df = spark.createDataFrame(
        [("a1", " AC/DC! ", "Rock; Hard Rock|Blues/", 150.0, "1973-11-01", [" Angus "]), ("a2", "", None, None, "soon", None)],
        "artist_id string, name string, genre string, popularity_score double, formation_date string, members array<string>")
    one, two = normalize.normalize_artists(df).orderBy("artist_id").collect()
    assert one["name_normalized"] == "ACDC" and one["genres_cleaned"] == ["rock", "hard rock", "blues"]
    assert one["popularity_score_normalized"] == 100.0 and one["data_quality_score"] == 100
    assert two["data_quality_score"] == 0 and two["popularity_score_normalized"] == 0.0


@pytest.mark.parametrize("text,plain,chained", [("Amphitheater", "amphitheater", "theater"), ("Town Hall", "hall", "hall"), ("Centre", "center", "center")])
def test_venue_types(spark, text, plain, chained):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(normalize.venue_type(F.col("t")).alias("a"), normalize.venue_type(F.col("t"), compat=True).alias("b")).first()
    assert (row["a"], row["b"]) == (plain, chained)


def test_validation_rate(spark):
    df = spark.createDataFrame([("a1", None), ("a2", "Good")], "artist_id string, name string")
    report = validate.upload_report(validate.mark(df, "artists", AS_OF)).first()
    assert (report["records_successful"], report["records_failed"], report["validation_rate"]) == (1, 1, 0.5)


def test_venue_location_is_lifted(spark):
    df = spark.createDataFrame(
        [("v1", "Hall", ("Paris", "FR", "France"), 500, "HALL")],
        "venue_id string, name string, location struct<city: string, state: string, country: string>, capacity int, venue_type string")
    valid, invalid = validate.split(df, "venues", AS_OF)
    assert invalid.count() == 0 and valid.first()["venue_type"] == "hall"


def test_sale_rules(spark):
    rows = [("s1", "c", "u", "vip", 2, 10.0, 20.0, "2024-01-01 10:00:00", "cash"),
            ("s2", "c", "u", "throne", 21, 10.0, 99.0, "2030-01-01 10:00:00", "gold")]
    df = spark.createDataFrame(
        rows, "sale_id string, concert_id string, customer_id string, ticket_tier string, quantity int, unit_price double, "
              "total_price double, purchase_timestamp string, payment_method string")
    errors = {r["sale_id"]: r["errors"] for r in validate.mark(df, "ticket_sales", AS_OF).collect()}
    assert errors["s1"] == [] and errors["s2"] == [
        "ticket_tier unknown", "quantity out of range", "total_price does not match", "purchase_timestamp in the future",
        "payment_method unknown"]


def test_fuzzy_scores_worked_out_by_hand():
    from encore.functions.text import fuzzy_score

    # letters in common, in order, twice, over both lengths; or over a stretch as long as the shorter text
    assert fuzzy_score("kitten", "sitting") == 0.67  # ittn in sittin: 8 of 12
    assert fuzzy_score("abcd", "abxd") == 0.75  # abd: 6 of 8
    assert fuzzy_score("blue note", "blue nots") == 0.89  # 16 of 18
    assert fuzzy_score("rolling stones", "stones rolling") == 1.0  # the same words
    assert fuzzy_score("arena hall", "arena hall two") == 1.0  # one text inside the other
    assert fuzzy_score("club", None) == 0.0 and fuzzy_score("abc", "xyz") == 0.0


def test_few_stretches_are_compared(monkeypatch):
    """The best stretch is the plain maximum over all; those that cannot win are not compared."""
    from encore.functions import text

    def plain(a, b):
        short, long = sorted((a, b), key=len)
        if not short or short in long:
            return 100 if short else 0
        either = [(short, long)] + [(long, short)] * (len(a) == len(b))
        return max(text.ratio(x, y[i:i + len(x)]) for x, y in either for i in range(len(y)))

    rng = random.Random(5)
    words = ["".join(rng.choice("abc 1") for _ in range(rng.randint(0, 9))) for _ in range(60)]
    assert all(text.partial_ratio(a, b) == plain(a, b) for a in words for b in words)
    compared = []
    one = text._common
    monkeypatch.setattr(text, "_common", lambda *given: compared.append(given) or one(*given))
    assert text.partial_ratio("customer 000000001", "customer 00000000z") == 94
    assert len(compared) < 8


def test_fuzzy_scores_of_one_file_are_dealt_over_tasks(spark, tmp_path):
    import __spark_entry__ as entry

    spark.createDataFrame([(i, f"Customer#{i:09d}", i % 3) for i in range(40)], "c_custkey long, c_name string, c_nationkey int").coalesce(1).write.parquet(
        str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(i, f"NATION_{i}") for i in range(3)], "n_nationkey int, n_name string").write.parquet(str(tmp_path / "nation.parquet"))
    scores = entry.queries()["x21_fuzzy_scores"](spark, str(tmp_path))
    assert scores.rdd.getNumPartitions() > 1 and scores.count() == 40
    assert scores.filter("same AND blank = 0 AND without_1 = 0.94 AND without_4 = 0.78").count() == 40


def test_chained_types_are_one_choice(spark):
    """The chain of replacements as one flat choice, not an expression that doubles with every word."""
    import itertools

    from encore.operators.normalize import CHAINED_WORDS, VENUE_WORDS, venue_type

    def chained(value):
        text = value.strip(" ").lower()
        for word in CHAINED_WORDS:
            text = VENUE_WORDS[word] if word in text else text
        return text

    texts = [" Old ", "Warehouse", *(f" {a.upper()} or {b}" for a, b in itertools.product(CHAINED_WORDS, repeat=2))]
    kind = venue_type(F.col("t"), compat=True)
    assert str(kind).count("contains") == len(CHAINED_WORDS)
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", kind.alias("kind")).collect()
    assert all(r["kind"] == (chained(r["t"]) if r["t"] is not None else None) for r in rows)
