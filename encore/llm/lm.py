"""An n-gram language model in a sharded Elias-Fano trie, trained and applied by Spark."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import eliasfano
from encore.llm.common import delete_folder, flushed
from encore.llm.hashing import word_hashes
from encore.session import cut_lineage, ensure_checkpoint_dir, shuffle_partitions

ORDER = 3
MIN_COUNT = 2
DISCOUNT = 0.75
CHUNK = 1_000_000  # tokens looked up at once
COUNTED = 3_000_000  # n-grams counted before they are sent on
_END = np.uint64(0x2545F4914F6CDD1D)  # stands for the end of a text


@dataclass
class Model:
    """Where the levels lie and how many entries every shard has; the entries themselves are in the files."""

    root: str
    shards: int
    order: int
    tokens: int  # N
    words: int  # V
    counts: list[list[int]] = field(default_factory=list)  # by level, by shard


def _local(path: str) -> str:
    return path[5:].replace("//", "", 1) if path.startswith("file:") else path


def _write(path: str, data: bytes) -> None:
    """Put a file in its place at once, so that a task that is run again replaces it by the same."""
    part = f"{path}.{uuid.uuid4().hex}"
    if "://" in path and not path.startswith("file:"):
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(path)
        with store.open_output_stream(f"{name}.{part[-32:]}") as out:
            out.write(data)
        store.move(f"{name}.{part[-32:]}", name)
        return
    name = _local(path)
    os.makedirs(os.path.dirname(name), exist_ok=True)
    part = _local(part)
    with open(part, "wb") as out:
        out.write(data)
    os.replace(part, name)


def _mapped(path: str) -> dict[str, np.ndarray]:
    """Memory-map a level file; a store that cannot be mapped is read into the machine's temporary folder first."""
    if "://" in path and not path.startswith("file:"):
        import tempfile

        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(path)
        with tempfile.NamedTemporaryFile() as copy, store.open_input_stream(name) as data:
            while block := data.read(1 << 22):
                copy.write(block)
            copy.flush()
            return eliasfano.from_file(copy.name)  # the mapping outlives the name
    return eliasfano.from_file(_local(path))


def quantised(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte per value and a codebook of 256: the values themselves if so few, else the means of equal steps."""
    if not len(logs):
        return np.zeros(0, np.uint8), np.zeros(256)
    few = np.unique(logs)
    if len(few) <= 256:
        code = np.searchsorted(few, logs).astype(np.uint8)
    else:
        code = np.minimum((logs - few[0]) * (256 / (few[-1] - few[0])), 255).astype(np.uint8)
    sums, hits = np.bincount(code, logs, 256), np.bincount(code, minlength=256)
    return code, sums / np.maximum(hits, 1)


class Trie:
    """The model's levels, opened as they are asked for.

    Level 1 holds the words: an Elias-Fano sequence of their hashes per shard, with exact counts; a word's number is
    its place over all shards. Level k holds n-grams of k words under their context, an entry of level k - 1: per
    shard (a range of contexts) the successors' numbers, made monotone by adding context times vocabulary, monotone
    pointers to each context's first successor, one-byte log probabilities, and one-byte backoffs of the contexts.
    """

    _open: dict = {}

    def __init__(self, model: Model):
        self.m = model
        self.base = model.words + 1  # one number per context stands for successors that are not kept
        self.offsets = [np.r_[0, np.cumsum(c)].astype(np.int64) for c in model.counts]

    def shard(self, level: int, number: int) -> dict:
        key = (self.m.root, level, number)
        if key not in Trie._open:
            if len(Trie._open) >= 8 * self.m.shards * self.m.order:
                Trie._open.clear()
            arrays = _mapped(f"{self.m.root}/level{level}/{number}.ef")
            Trie._open[key] = {"arrays": arrays, "keys": eliasfano.EliasFano(arrays, "keys_")}
            if level > 1:
                Trie._open[key]["pointers"] = eliasfano.EliasFano(arrays, "pointers_")
        return Trie._open[key]

    def size(self, level: int) -> int:
        return int(self.offsets[level - 1][-1]) if level <= len(self.offsets) else 0

    def low(self, level: int, shard: np.ndarray | int):
        """First context of a shard of the level."""
        return -(-shard * self.size(level - 1) // self.m.shards)

    def shard_of(self, level: int, context: np.ndarray) -> np.ndarray:
        return context * self.m.shards // max(self.size(level - 1), 1)

    def _each(self, shards: np.ndarray):
        """(shard, places of it) of a sorted array of shard numbers."""
        edges = np.flatnonzero(np.diff(shards)) + 1
        for part in np.split(np.arange(len(shards)), edges):
            if len(part):
                yield int(shards[part[0]]), part

    def words(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the words with these hashes, -1 for unknown ones."""
        unique, back = np.unique(hashes, return_inverse=True)
        out = np.full(len(unique), -1, np.int64)
        shards = word_shard(unique, self.m.shards)
        for shard, part in self._each(shards):
            if self.m.counts[0][shard]:
                place = self.shard(1, shard)["keys"].find(unique[part] - np.uint64(first_hash(shard, self.m.shards)))
                out[part] = np.where(place >= 0, place + self.offsets[0][shard], -1)
        return out[back]

    def word_counts(self, numbers: np.ndarray) -> np.ndarray:
        """Exact training counts; 0 for unknown words."""
        out = np.zeros(len(numbers), np.int64)
        order = np.argsort(numbers, kind="stable")
        order = order[numbers[order] >= 0]
        known = numbers[order]
        shards = np.searchsorted(self.offsets[0], known, "right") - 1
        for shard, part in self._each(shards):
            counts = self.shard(1, shard)["arrays"]["counts"]
            out[order[part]] = counts[known[part] - self.offsets[0][shard]]
        return out

    def word_logs(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.m.tokens + 1 * (self.m.words + 1)))

    def find(self, level: int, context: np.ndarray, word: np.ndarray):
        """(entry or -1, log probability of entries, log backoff of contexts) of successors ``word`` under ``context``.

        The search is relative to the context: its shard's successors are one sequence in which every context has a
        stretch of its own, and the word's successor in that stretch is looked up. Contexts and words must be known.
        """
        entry = np.full(len(context), -1, np.int64)
        prob, back = np.zeros(len(context)), np.zeros(len(context))
        if level > len(self.offsets) or not self.size(level - 1):
            return entry, prob, back
        unique, inverse = np.unique(context * self.base + word, return_inverse=True)
        own = unique // self.base
        found, logs, backs = np.full(len(unique), -1, np.int64), np.zeros(len(unique)), np.zeros(len(unique))
        for shard, part in self._each(self.shard_of(level, own)):
            data = self.shard(level, shard)
            first, arrays = int(self.low(level, shard)), data["arrays"]
            place = data["keys"].find(unique[part] - first * self.base)
            hit = place >= 0
            found[part[hit]] = place[hit] + self.offsets[level - 1][shard]
            logs[part[hit]] = arrays["book"][arrays["probs"][place[hit]]]
            backs[part] = arrays["back_book"][arrays["backs"][own[part] - first]]
        return found[inverse], logs[inverse], backs[inverse]

    def last_words(self, level: int, entries: np.ndarray) -> np.ndarray:
        """The last word of entries of a level."""
        if level == 1:
            return entries
        unique, inverse = np.unique(entries, return_inverse=True)
        out = np.zeros(len(unique), np.int64)
        for shard, part in self._each(np.searchsorted(self.offsets[level - 1], unique, "right") - 1):
            keys = self.shard(level, shard)["keys"].access(unique[part] - self.offsets[level - 1][shard])
            out[part] = (keys % np.uint64(self.base)).astype(np.int64)
        return out[inverse]

    def suffixes(self, level: int, entries: np.ndarray) -> np.ndarray:
        """The entry of level ``level`` - 1 that an entry's words but the first make, or -1 where it is not kept."""
        if level == 2:
            return self.last_words(2, entries)
        unique, inverse = np.unique(entries, return_inverse=True)
        context = np.zeros(len(unique), np.int64)
        for shard, part in self._each(np.searchsorted(self.offsets[level - 1], unique, "right") - 1):
            keys = self.shard(level, shard)["keys"].access(unique[part] - self.offsets[level - 1][shard])
            context[part] = (keys // np.uint64(self.base)).astype(np.int64) + int(self.low(level, shard))
        lower = self.suffixes(level - 1, context)
        out, known = np.full(len(unique), -1, np.int64), np.flatnonzero(lower >= 0)
        last = self.last_words(level, unique[known])
        out[known] = self.find(level - 1, lower[known], last)[0]
        return out[inverse]

    def logs_under(self, level: int, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 P(word | the words of an entry ``context`` of level ``level`` - 1), -1 standing for no context."""
        if level == 1:
            return self.word_logs(self.word_counts(word))
        out = np.zeros(len(word))
        known = context >= 0
        if not known.all():
            out[~known] = self.logs_under(level - 1, context[~known], word[~known])
        at = np.flatnonzero(known)
        if len(at):
            entry, logs, backs = self.find(level, context[at], word[at])
            out[at] = logs
            miss = entry < 0
            if miss.any():
                lower = self.suffixes(level - 1, context[at][miss]) if level > 2 else np.full(miss.sum(), -1)
                out[at[miss]] = backs[miss] + self.logs_under(level - 1, lower, word[at[miss]])
        return out


def first_hash(shard: int, shards: int) -> int:
    """Least hash of a shard: the upper 32 bits times shards, divided by 2**32, is the shard."""
    return (-(-(shard << 32) // shards)) << 32


def word_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _chunks(batches, size: int = CHUNK):
    """(rows, starts, hashes): documents of about ``size`` tokens, each as end, words, end; starts has their places."""
    rows, parts, held = [], [], 0
    end = np.array([_END])
    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        for at in range(batch.num_rows):
            rows.append([c[at].as_py() for i, c in enumerate(columns) if i != 1])
            parts.append(np.concatenate([end, word_hashes(columns[1][at].as_py()), end]))
            held += len(parts[-1])
            if held >= size:
                yield rows, np.r_[0, np.cumsum([len(p) for p in parts])], np.concatenate(parts)
                rows, parts, held = [], [], 0
    if rows:
        yield rows, np.r_[0, np.cumsum([len(p) for p in parts])], np.concatenate(parts)


def _planes(values: np.ndarray) -> bytes:
    """Compressed bytes of integers, the first byte of each first, then the second, and so on."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def _unplanes(data: bytes, kind) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def _counted(docs: DataFrame, model: Model | None, level: int, shards: int) -> DataFrame:
    """(shard, keys, counts): n-grams of ``level`` words counted in parts, keys as differences of sorted numbers.

    On level 1 the keys are hashes. Above, an n-gram is counted under its context if the context is kept; a word that
    cannot be kept, as the n-gram without its first word is not, counts for the context as a whole.
    """
    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("shard", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
        trie = Trie(model) if model else None

        def grams():
            for _, starts, hashes in _chunks(batches):
                if level == 1:
                    yield np.delete(hashes, starts[:-1])
                    continue
                numbers = trie.words(hashes)
                context, word, opened = numbers[:-1], numbers[1:], np.zeros(len(hashes) - 1, bool)
                opened[starts[1:-1] - 1] = True  # from one document's end to the next one's start
                if level == 2:
                    yield (context * trie.base + word)[~opened]
                    continue
                at = np.flatnonzero(~opened)
                for k in range(2, level):
                    # entry of the k words that end at each place; then the context moves one word on
                    found = np.full(len(context), -1, np.int64)
                    found[at] = trie.find(k, context[at], word[at])[0]
                    if k == level - 1:
                        keep = np.flatnonzero((found[:-1] >= 0) & ~opened[1:])
                        after, lower = word[1:][keep], found[1:][keep]
                        yield found[:-1][keep] * trie.base + np.where(lower >= 0, after, trie.base - 1)
                    else:
                        at = np.flatnonzero((found[:-1] >= 0) & ~opened[1:]) + 1
                        context = np.r_[-1, found[:-1]]

        def parts():
            held, size = [], 0
            for keys in grams():
                held.append(keys)
                size += len(keys)
                if size >= COUNTED:
                    yield held
                    held, size = [], 0
            if size:
                yield held

        def rows():
            for held in parts():
                keys, counts = np.unique(np.concatenate(held), return_counts=True)
                place = word_shard(keys, shards) if level == 1 else trie.shard_of(level, keys // trie.base)
                for part in np.split(np.arange(len(keys)), np.flatnonzero(np.diff(place)) + 1):
                    own = keys[part].astype(np.uint64)
                    yield (
                        int(place[part[0]]), _planes(np.diff(own, prepend=np.uint64(0))),
                        _planes(counts[part].astype(np.uint32)),
                    )

        yield from flushed(rows(), schema, limit=4 << 20, weigh=lambda r: 64 + len(r[1]) + len(r[2]))

    return docs.mapInArrow(run, "shard bigint, keys binary, counts binary")


def _summed(rows) -> tuple[np.ndarray, np.ndarray]:
    keys = [np.cumsum(_unplanes(k.as_py(), np.uint64), dtype=np.uint64) for k in rows.column("keys")]
    counts = [_unplanes(c.as_py(), np.uint32).astype(np.int64) for c in rows.column("counts")]
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


def _build_words(root: str, shards: int):
    def build(rows):
        import pyarrow as pa

        shard = rows.column("shard")[0].as_py()
        keys, counts = _summed(rows)
        low = first_hash(shard, shards)
        universe = (first_hash(shard + 1, shards) if shard + 1 < shards else 1 << 64) - low
        arrays = {f"keys_{k}": v for k, v in eliasfano.encode(keys - np.uint64(low), universe).items()}
        arrays["counts"] = counts if counts.max() >= 1 << 32 else counts.astype(np.uint32)
        _write(f"{root}/level1/{shard}.ef", eliasfano.to_bytes(arrays))
        return pa.table({"shard": [shard], "entries": [len(keys)], "tokens": [int(counts.sum())]})

    return build


def _build_level(model: Model, level: int, min_count: int, discount: float):
    def build(rows):
        import pyarrow as pa

        trie = Trie(model)
        shard = rows.column("shard")[0].as_py()
        first, last = int(trie.low(level, shard)), int(trie.low(level, shard + 1))
        keys, counts = _summed(rows)
        keys = keys.astype(np.int64) - first * trie.base
        context, word = keys // trie.base, keys % trie.base
        whole = np.bincount(context, counts, last - first)
        keep = (counts >= min_count) & (word < trie.base - 1)
        keys, counts, context, word = keys[keep], counts[keep], context[keep], word[keep]
        share = (counts - discount) / whole[context]
        left = np.where(whole > 0, 1 - np.bincount(context, share, last - first), 1.0)
        entries = context + first
        lower = trie.suffixes(level - 1, entries) if level > 2 else np.full(len(entries), -1, np.int64)
        logs = np.log10(share + left[context] * 10 ** trie.logs_under(level - 1, lower, word))
        probs, book = quantised(logs)
        backs, back_book = quantised(np.log10(np.maximum(left, 1e-9)))
        arrays = {f"keys_{k}": v for k, v in eliasfano.encode(keys, (last - first) * trie.base).items()}
        pointers = np.r_[0, np.cumsum(np.bincount(context, minlength=last - first))]
        arrays |= {f"pointers_{k}": v for k, v in eliasfano.encode(pointers, len(keys) + 1).items()}
        arrays |= {"probs": probs, "book": book, "backs": backs, "back_book": back_book}
        _write(f"{model.root}/level{level}/{shard}.ef", eliasfano.to_bytes(arrays))
        return pa.table({"shard": [shard], "entries": [len(keys)], "tokens": [0]})

    return build


def _gathered(parts: DataFrame, build, shards: int) -> tuple[list[int], int]:
    """Build every shard's file in a task of its own; what comes back is one row per shard."""
    rows = parts.groupBy("shard").applyInArrow(build, "shard bigint, entries bigint, tokens bigint").collect()
    entries = [0] * shards
    for row in rows:
        entries[row.shard] = row.entries
    return entries, sum(row.tokens for row in rows)


def train(
    docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, discount: float = DISCOUNT,
    text_col: str = "text", shards: int | None = None,
) -> Model:
    """Count the n-grams of all texts and write the trie's levels into the shared checkpoint folder.

    Level by level, every task counts its part of the texts and sends compressed sorted counts to the shards; a
    shard's task adds them up and writes one file. N-grams of two words and more are kept from ``min_count``
    occurrences on; the probabilities of kept ones lose ``discount`` of a count, and that mass and the pruned counts'
    go to the shorter context: P = (c - d) / C + left * P_shorter, so the words of every context sum to one before
    quantisation. The words themselves are smoothed by adding one, with one unknown word.
    """
    spark = docs.sparkSession
    shards = shards or shuffle_partitions(spark)
    root = f"{ensure_checkpoint_dir(spark)}/ngrams-{uuid.uuid4().hex}"
    texts = docs.select(F.lit(None).cast("int").alias("none"), F.col(text_col).cast("string").alias("text"))
    words, tokens = _gathered(_counted(texts, None, 1, shards), _build_words(root, shards), shards)
    model = Model(root, shards, order, tokens, sum(words), [words])
    for level in range(2, order + 1):
        if not sum(model.counts[-1]):
            break
        entries, _ = _gathered(
            _counted(texts, model, level, shards), _build_level(model, level, min_count, discount), shards
        )
        model.counts.append(entries)
        _fill_gaps(spark, model, level)
    return model


def _fill_gaps(spark, model: Model, level: int) -> None:
    """Shards without any n-gram get a file that says so, for contexts that were never followed by anything."""
    trie = Trie(model)
    for shard, entries in enumerate(model.counts[level - 1]):
        size = int(trie.low(level, shard + 1)) - int(trie.low(level, shard))
        path = f"{model.root}/level{level}/{shard}.ef"
        if not entries and size and not _exists(path):
            arrays = {f"keys_{k}": v for k, v in eliasfano.encode(np.zeros(0, np.uint64), size * trie.base).items()}
            arrays |= {f"pointers_{k}": v for k, v in eliasfano.encode(np.zeros(size + 1, np.uint64), 1).items()}
            arrays |= {"probs": np.zeros(0, np.uint8), "book": np.zeros(256), "backs": np.zeros(size, np.uint8),
                       "back_book": np.zeros(256)}
            _write(path, eliasfano.to_bytes(arrays))


def _exists(path: str) -> bool:
    if "://" in path and not path.startswith("file:"):
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(path)
        return store.get_file_info(name).type != fs.FileType.NotFound
    return os.path.exists(_local(path))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known, base_score, score (both log10 of the whole text).

    A token's score comes from the longest kept n-gram that ends with it; where a longer context is kept without it,
    that context's backoff is added. The levels are memory-mapped, so what a task holds is its texts' tokens.

    A null text is an empty one and has the end as its only token; an empty model gives each token the probability
    one; null identifiers, repeated rows and other columns do no harm; an empty table gives no rows.
    """
    kind = docs.select(F.col(id_col).alias("doc_id")).schema[0].dataType
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        schema = pa.schema([
            ("doc_id", to_arrow_type(kind)), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
            ("base_score", pa.float64()), ("score", pa.float64()),
        ])
        trie = Trie(model)

        def rows():
            for held, starts, hashes in _chunks(batches):
                numbers = trie.words(hashes) if model.words else np.full(len(hashes), -1, np.int64)
                counts = trie.word_counts(numbers) if model.words else np.zeros(len(hashes), np.int64)
                base = trie.word_logs(counts)
                logs = base.copy()
                context = np.r_[-1, numbers[:-1]]
                context[starts[:-1]] = -1
                for level in range(2, len(model.counts) + 1):
                    # context: the entry of level - 1 made of the words before each place, where it is kept
                    entry = np.full(len(hashes), -1, np.int64)
                    back = np.zeros(len(hashes))
                    at = np.flatnonzero((context >= 0) & (numbers >= 0))
                    entry[at], found, back[at] = trie.find(level, context[at], numbers[at])
                    odd = np.flatnonzero((context >= 0) & (numbers < 0))
                    back[odd] = trie.find(level, context[odd], np.full(len(odd), trie.base - 1))[2]
                    logs = logs + back
                    hit = entry[at] >= 0
                    logs[at[hit]] = found[hit]
                    context = np.r_[-1, entry[:-1]]
                    context[starts[:-1]] = -1
                base[starts[:-1]] = logs[starts[:-1]] = 0
                known = counts > 0
                known[starts[:-1]] = False
                sums = [np.add.reduceat(x, starts[:-1]) for x in (known.astype(np.int64), base, logs)]
                for i, row in enumerate(held):
                    yield row[0], int(starts[i + 1] - starts[i] - 1), int(sums[0][i]), float(sums[1][i]), float(sums[2][i])

        yield from flushed(rows(), schema)

    return slim.mapInArrow(
        run, f"doc_id {kind.simpleString()}, n_tokens bigint, n_known bigint, base_score double, score double"
    )


def forget(spark: SparkSession, model: Model) -> None:
    """Delete the model's files."""
    delete_folder(spark, model.root)


def score_corpus(
    docs: DataFrame, held_out: Callable[[Column], Column], order: int = ORDER, id_col: str = "doc_id",
    text_col: str = "text", min_count: int = 1,
) -> DataFrame:
    """Train on the rows whose identifier is not ``held_out``, then score all rows; n-grams seen once are kept as well.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. The scores are written to the
    checkpoint folder and the model's files go.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = train(slim.where(~held_out(F.col("doc_id"))), order, min_count)
    scored = cut_lineage(score(slim, model))
    forget(docs.sparkSession, model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )
