"""Operators whose result for a row follows from rules on its text, against plain Python."""

import hashlib
from collections import Counter, defaultdict

import plain
import pytest
from pyspark.sql import functions as F

from encore.llm import exact, mixing, pii, quality, registry, secrets, sharding, tokens
from encore.llm.spans import none_over

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    given = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source")
    odd = spark.createDataFrame([(None if r[0] is None else r[0] + 1_000_000, *r[1:]) for r in plain.awkward()], plain.SCHEMA)
    return given.unionByName(odd, allowMissingColumns=True).repartition(5).cache()


@pytest.fixture(scope="module")
def rows(table):
    return [r.asDict() for r in table.collect()]


def empty(spark):
    return spark.createDataFrame([], plain.SCHEMA)


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_line_first_cleaning(spark, table, rows):
    got = bag(
        quality.clean(table), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    assert got == Counter((r["doc_id"], *plain.signals(r["text"])) for r in rows)
    assert quality.clean(empty(spark)).count() == 0


def test_lines():
    assert quality.line_fault("Home | About | Contact | Help | Login") == "navigation"
    assert quality.line_fault("We use cookies, see our privacy policy.") == "boilerplate"
    assert quality.line_fault("no mark in this line of at least eight words") == "punctuation"
    assert quality.line_fault("An ordinary sentence, with a comma and its end.") == ""
    assert quality.line_fault("Short heading") == "" and quality.line_fault("") == ""
    body = " ".join(f"Line {i} says a{i}, b{i} and c{i}, all of it in order." for i in range(4))
    kept = quality.judge(body + "\nHome | About | Contact | Help | Login\n" + "Another good sentence stands here.")
    assert kept[6] and "Home" not in kept[-1] and kept[-1].endswith("here.")
    lost = quality.judge("\n".join([body] + [f"link{i} | a{i} | b{i} | c | d" for i in range(9)]))
    assert not lost[5] and not lost[6]
    assert quality.judge(body)[-1] == body


PROSE = """The ferry left the harbour a little after seven, when the fog
had lifted enough to see the far pier. Nobody on board spoke
about the night before, although most of them had been there
Anna among them, and had heard the bells ring until morning.

On the other side a man with two dogs was waiting for the post
which he carried up the hill every day except Sunday (and, as
he liked to say, "on every day that Sunday had forgotten.")"""
VERSE = "\n".join(f"the {a} wind goes over the {b} hill\nand no one hears it," for a, b in zip("abcdefg", "hijklmn")) + "\nnot even the sea."
LIST = "Buy these before Friday:\n" + "\n".join(f"- {n} {w}" for n, w in enumerate("flour sugar yeast salt butter milk eggs cream".split()))
HEADLINES = "\n".join(
    f"{a} Minister Opens New Bridge Over River Near {b}" for a, b in zip(("Prime", "Former Deputy", "Acting"), ("Lund", "Rye Town Hall", "Ulm")))


def test_wrapped_prose_verse_and_lists_stay():
    for text in (PROSE, VERSE, LIST):
        signals = quality.judge(text)
        assert signals[6] and signals[-1] == text, text
    assert not quality.judge(HEADLINES)[6]  # no line continues another, no line closes
    menu = "\n".join("Home | About | Contact | Help | Login | more" for _ in range(3))
    mixed = quality.judge(PROSE + "\n" + menu)
    assert mixed[6] and "Home" not in mixed[-1] and mixed[-1].startswith(PROSE[:300])
    assert quality.line_fault('He said to all of us there: "we will go home."') == ""
    assert quality.line_fault("one two three four five six seven (eight.)") == ""
    assert quality.line_fault("one two three four five six seven (eight)") == "punctuation"


def test_verdicts_against_the_plain_rules(spark, table, rows):
    texts = [r["text"] for r in rows] + [PROSE, VERSE, LIST, HEADLINES, PROSE + "\n" + HEADLINES, PROSE.replace("\n\n", "\n")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.kept, r.lost_words) for r in quality.clean(docs).collect()}
    assert got == {i: plain.verdict(t) for i, t in enumerate(texts)}


def test_shards(spark, table, rows):
    got = sharding.shard_by_bytes(table).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 1, plain.crc(r["text"])) for r in rows
    )
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    for shard in range(16):
        assert abs(sum(r["size"] for r in by[shard]) - total / 16) <= largest
        assert sorted(r.slot for r in by[shard]) == list(range(len(by[shard])))
    order = sorted(got, key=lambda r: (r["shard"], r.slot))
    ids = [-1 if r.doc_id is None else r.doc_id for r in order]
    assert ids == sorted(ids)
    assert sharding.shard_by_bytes(empty(spark)).count() == 0


def test_pii_base(spark, table, rows):
    got = bag(pii.digests(pii.find_pii(table)), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")

    def want(r):
        spans = plain.pii(r["text"])
        kinds = Counter(s[0] for s in spans)
        return (r["doc_id"], *[kinds[k] for k in ("email", "ip", "card", "phone")], plain.sha(plain.joined(spans)))

    assert got == Counter(map(want, rows))
    assert pii.find_pii(empty(spark)).count() == 0


def test_pii_learns_contexts(spark):
    texts = [f"Some words first. Reach me under {x} any time." for x in
             [f"a{i}@mail.example.com" for i in range(8)] + ["ann(at)host9"]]
    texts += [f"We saw room {i} of 90210 there." for i in range(8)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.spans for r in pii.digests(pii.find_pii(docs)).collect()}
    start = texts[8].index("ann")
    assert found[8] == f"email:{start}:{start + len('ann(at)host9')}"
    assert all(found[i] == "" for i in range(9, 17))


def test_secrets(spark, table, rows):
    got = bag(secrets.digests(secrets.find_secrets(table)), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")

    def want(r):
        spans = plain.secrets(r["text"])
        kinds = Counter(s[0] for s in spans)
        return (r["doc_id"], *[kinds[k] for k in ("assign", "access", "hex")], plain.sha(plain.joined(spans)))

    assert got == Counter(map(want, rows))
    assert secrets.find_secrets(empty(spark)).count() == 0


def test_ownership(spark):
    own, copied = "q8Zr2LmT9xVb4KdW7nPs", "hT5kQ2wE8rY1uI4oP7aS"
    docs = spark.createDataFrame(
        [(1, f"key {own} here", "a"), (2, f"key {own} again", "a")]
        + [(10 + i, f"say {copied} or token={copied}", f"o{i}") for i in range(5)] + [(20, None, None)],
        "doc_id bigint, text string, source string",
    )
    got = {r.doc_id: r for r in secrets.digests(secrets.find_secrets(docs)).collect()}
    assert got[1].spans == f"token:4:{4 + len(own)}" and got[1].n_live == 1
    assert got[10].spans.startswith("assign:") and got[10].n_copied == 1 and got[20].spans == ""


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("partitions", [3, 40])
def test_exact(spark, table, rows, keep, partitions):
    got = exact.dedupe_exact(table, keep=keep, partitions=partitions).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r["doc_id"])
    pick = max if keep == "largest" else min
    want, kept = Counter(), Counter()
    for text, ids in groups.items():
        best = pick((i for i in ids if i is not None), default=None)
        kept[best, plain.sha(text)] = 1
        for i in ids:
            want[i, best, len(ids), plain.sha(text)] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert Counter((r.doc_id, r.text_sha256) for r in got if r.kept) == kept
    assert exact.dedupe_exact(empty(spark)).count() == 0


def test_exact_normalised(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "A b"), (2, "a B"), (3, None)], "doc_id bigint, text string")
    got = {r.doc_id: r.keep_id for r in exact.dedupe_exact(docs, normalise=F.lower, keep="smallest").collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def water(sizes, weights, most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(capped.values())) / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        if not over:
            return {**capped, **{s: level * weight[s] for s in free}}
        capped.update({s: most * sizes[s] for s in over})


def test_mix(spark, table, rows):
    mixed = mixing.mix(table)
    got = mixed.collect()
    assert Counter((r.doc_id, r["size"], r.source) for r in got) == Counter(
        (r["doc_id"], len(plain.words(r["text"])), r["source"]) for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len(plain.words(r["text"]))
    goal, taken, largest = water(sizes, (5, 2, 1)), Counter(), Counter()
    for r in got:
        assert r.taken == r.copies * r["size"] <= 3 * r["size"] and len(r["shards"]) == r.copies
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= largest[s]
    again = {(r.doc_id, r["size"]): (r.taken, r["shards"]) for r in mixing.mix(table.repartition(7)).collect()}
    assert again == {(r.doc_id, r["size"]): (r.taken, r["shards"]) for r in got}
    assert mixing.mix(empty(spark)).count() == 0


def test_split_tree(spark):
    draws = spark.createDataFrame(
        [(s, b, p) for s, n in (("a", 40), ("b", 20), (None, 4)) for b in range(n) for p in (0, 1)],
        "source string, block int, pass int",
    )
    for shards in (1, 5, 16):
        got = mixing.split_tree(draws, shards).collect()
        assert {(r.source, r.block, r["pass"]) for r in got} == {tuple(r) for r in draws.collect()} and len(got) == 128
        counts = Counter(r.shard for r in got)
        assert set(counts) == set(range(shards)) and max(counts.values()) - min(counts.values()) <= 4


def test_tokens(spark, table, rows):
    import public_tokenizers

    file, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    tool = tokens.encoder(file, pattern)
    whole = {t: tool.encode_ordinary(t) for t in {r["text"] or "" for r in rows}}
    for size in (tokens.CHUNK, 50):
        got = tokens.encode(table, file, pattern, size=size).collect()
        assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in got) == Counter(
            (r["doc_id"], tuple(whole[r["text"] or ""]), (r["text"] or "").encode()) for r in rows)
    digests = {r.doc_id: r for r in tokens.digests(tokens.encode(table, file, pattern)).collect()}
    for r in rows:
        if r["doc_id"] is not None:
            ids = whole[r["text"] or ""]
            assert digests[r["doc_id"]].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert digests[r["doc_id"]].n_tokens == len(ids)
    assert tokens.encode(empty(spark), file, pattern).count() == 0


@pytest.mark.parametrize("run", [" " * 30_000, "\n" * 12_000, "\u3000" * 11_000, "\x85\xa0\u2003\t" * 4_000, "漢" * 40_000, "x" * 40_000, "." * 40_000])
def test_long_runs_are_encoded_as_one(run):
    import public_tokenizers

    tool = tokens.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for text in (run, f"w{run}x", f"a.{run} .{run}\x1c{run}", f"{run}'s 1", f"a \n{run}\n b c {run}"):
        assert tokens._ids(tool, text, tokens.CHUNK) == tool.encode_ordinary(text)


@pytest.mark.parametrize("text", ["w" + "\n" * 1_000_000 + "x", " " * 5_000_000, "\u3000" * 2_000_000 + "x", "漢" * 1_000_000])
def test_runs_the_matcher_cannot_take(text):
    import public_tokenizers

    tool = tokens.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert tool.decode_bytes(tokens._ids(tool, text, tokens.CHUNK)) == text.encode()


def test_empty_documents_of_a_capped_source(spark):
    rows = [(i, "" if i < 40 else "one two three", "small") for i in range(60)]
    rows += [(100 + i, "word " * 50, "large") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix(docs, weights=(1, 20)).collect()  # large comes first and has the small weight
    assert {r.copies for r in got if r.source == "small"} == {mixing.MAX_REPEAT}
    taken = mixing.mixed_documents(docs, weights=(1, 20)).where("source = 'small'").groupBy("doc_id").count().collect()
    assert {r["count"] for r in taken} == {mixing.MAX_REPEAT} and len(taken) == 60


def test_registered_names():
    assert all(name.startswith("op") for name in registry.QUERIES)


def test_one_owner_with_many_repositories(spark):
    """Repositories count as well: 500 of one owner are a copied value, a few of one owner a live one."""
    wide, own, weak, steps = "q8Zr2LmT9xVb4KdW7nPs", "hT5kQ2wE8rY1uI4oP7aS", "z1z1z1z1z1z1z1z1z1z1z1z1", "abcdefghijklmnop1234567890"
    rows = [(i, f"password = {wide}", "one") for i in range(500)]
    rows += [(1000 + i, f"secret: {own} {weak} {steps}", "two") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = {r.doc_id: r.spans for r in secrets.find_secrets(docs).collect()}
    assert all([(s.verdict, s.repositories, s.owners) for s in found[i]] == [("copied", 500, 1)] for i in range(500))
    assert all([(s.verdict, s.repositories, s.owners) for s in found[i]] == [("live", 3, 1)] for i in range(1000, 1003))
    fewer = {r.doc_id: r.spans[0].verdict for r in secrets.find_secrets(docs, min_copied_repositories=501).collect()}
    assert fewer[0] == "live"


def test_entropy(spark):
    values = ["", "aaaa", "abcd", "aabb", "q8Zr2LmT9xVb4KdW7nPs", "0123456789abcdef"]
    import math
    made = spark.createDataFrame([(v,) for v in values], "v string")
    got = made.select("v", secrets.entropy(F.col("v")).alias("e"), secrets.stepping(F.col("v")).alias("s")).collect()
    for r in got:
        want = -sum(n / len(r.v) * math.log2(n / len(r.v)) for n in Counter(r.v).values())
        assert abs(r.e - want) < 1e-9
    assert [r.s for r in got][1:4] == [0, 0.75, 0.25] and got[5].s == 14 / 16


def test_texts_with_very_many_matches(spark):
    import time

    many = {
        "mail": " ".join(f"a{i}@b.cc" for i in range(200_000)),
        "units": " ".join(f"w{i}" for i in range(200_000)),
        "assign": " ".join(f"token=abcdef{i % 7}x" for i in range(200_000)),
        "mixed": " ".join(f"é{i} token: k{i}q8Zr2LmT9xVb4KdW7nPs 10.0.{i % 300}.1" for i in range(5_000)),
    }
    docs = spark.createDataFrame(list(enumerate(many.values())), "doc_id bigint, text string").withColumn("source", F.lit("s"))
    begun = time.time()
    personal = {r.doc_id: r for r in pii.digests(pii.find_pii(docs)).collect()}
    secret = {r.doc_id: r for r in secrets.digests(secrets.find_secrets(docs)).collect()}
    took = time.time() - begun
    for i, text in enumerate(many.values()):
        assert personal[i].base_sha256 == plain.sha(plain.joined(plain.pii(text)))
        assert secret[i].base_sha256 == plain.sha(plain.joined(plain.secrets(text)))
    assert personal[0].n_email == 200_000 and secret[2].n_assign == 200_000
    assert took < 300, took  # with the square of the matches it was hours


def test_free_of_spans(spark):
    spans = [(2, 4), (4, 7), (10, 11), (20, 30)]
    rows = [(s, e) for s in range(33) for e in range(s + 1, 34)]
    made = spark.createDataFrame(rows, "s int, e int")
    for n in range(len(spans) + 1):
        held = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in spans[:n]]).cast(
            "array<struct<start:int,end:int>>")
        got = {(r.s, r.e): r.free for r in made.select("s", "e", none_over(held, F.col("s"), F.col("e")).alias("free")).collect()}
        assert got == {(s, e): all(b <= s or a >= e for a, b in spans[:n]) for s, e in rows}
