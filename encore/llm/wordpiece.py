"""Ids of a local tokenizers file, word by word with a bounded memory of words."""

from __future__ import annotations

import itertools
import operator
import re
from collections.abc import Iterable, Iterator

BLOCK = 1 << 20  # bytes of a text that are split into words at once, give or take a word
MEMORY = 1_600_000  # words remembered by a process; more than that and the later half goes
LONGEST = 64  # bytes of a word that is remembered
_MARK = "\x00"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_open: dict = {}


class WordIds:
    """Encodes texts by a tokenizer whose words never reach over white space.

    That holds for files that drop white space before the merges, which :meth:`__init__` tests by an example. Words met
    for the first time are encoded together. Words of letters alone end at the ids that close a word; one full stop or
    comma behind them is a word of its own. Other words are parted by a mark of one known id; those that hold the mark
    itself are encoded alone. ASCII letters are lowered first if the file does so, which makes more words equal.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tool = Tokenizer.from_file(path)
        self.tool.encode_special_tokens = True  # a text that spells a special token is a text
        self.known: dict[bytes, bytes] = {}
        mark = self._ids(_MARK)
        if len(mark) != 4 or self._ids("ab  cd\n, e") != b"".join(map(self._ids, ("ab", "cd", ",", "e"))):
            raise ValueError(f"{path} does not part words at white space")
        self.mark = int.from_bytes(mark, "little")
        self.lowers = self._ids("ABC Def") == self._ids("abc def")
        suffix = getattr(self.tool.model, "end_of_word_suffix", None)
        self.closes = self._closing(suffix) if suffix else None
        # lower-case ASCII letters need neither the file's normalisation nor its split
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer = normalizers.Sequence([])
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        ])
        alphabet = "a b c d e f g h i j k l m n o p q r s t u v w x y z the quick brown fox abcdefghijklmnopqrstuvwxyz"
        if not self.lowers or self._ids(alphabet, self.merges) != self._ids(alphabet):
            self.merges = self.tool

    def _ids(self, text: str, tool=None) -> bytes:
        import numpy as np

        return np.array((tool or self.tool).encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def _closing(self, suffix: str):
        """Which ids are the last of a word."""
        import numpy as np

        vocabulary = self.tool.get_vocab(with_added_tokens=False)
        out = np.zeros(max(vocabulary.values()) + 1, bool)
        out[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        return out

    def _apart(self, words: list[bytes], whole: bytes, ends) -> None:
        """Remember the words whose ids end before the positions ``ends`` of ``whole``; the mark between is skipped."""
        import numpy as np

        skip = len(ends) > 0 and len(whole) // 4 > ends[-1]
        starts = np.r_[0, ends[:-1] + (1 if skip else 0)]
        self.known.update((w, whole[4 * a:4 * b]) for w, a, b in zip(words, starts.tolist(), ends.tolist()))

    def _learn(self, words: list[bytes]) -> None:
        import numpy as np

        parts, other = [], []
        for w in words:
            stop = len(w) - 1 if len(w) > 1 and w[-1] in b".," else len(w)
            core = w[:stop]
            if self.closes is not None and (core.isalpha() or core.decode().isalpha()):
                parts.append((w, core.lower() if self.lowers and core.isascii() else core, w[stop:]))
            else:
                other.append(w)
        fresh = {core for _, core, _ in parts}.difference(self.known)
        simple = [core for core in fresh if core.isalpha()]
        for cores, tool in ((simple, self.merges), (list(fresh.difference(simple)), self.tool)):
            if not cores:
                continue
            whole = self._ids(b" ".join(cores).decode(), tool)
            ends = np.flatnonzero(self.closes[np.frombuffer(whole, "<u4")]) + 1
            if len(ends) == len(cores):
                self._apart(cores, whole, ends)
            else:  # a letter here is none to the tokenizer
                other += cores
        alone = [w for w in other if _MARK.encode() in w]
        self.known.update((w, self._ids(w.decode())) for w in alone)
        marked = [w for w in other if _MARK.encode() not in w]
        if marked:
            whole = self._ids(" ".join([w.decode() + f" {_MARK}" for w in marked]))
            self._apart(marked, whole, np.flatnonzero(np.frombuffer(whole, "<u4") == self.mark))
        marks = {tail: self._ids(tail.decode()) for tail in {tail for _, _, tail in parts}}
        self.known.update((w, self.known[core] + marks[tail]) for w, core, tail in parts)

    def _words(self, block: bytes, ascii_only: bool) -> list[bytes]:
        return (block.lower() if self.lowers and ascii_only else block).split()

    def _encoded(self, lists: list[list[bytes]]) -> list[bytes]:
        """The ids of each list of words; new words of all lists are learnt at once."""
        if len(self.known) > MEMORY:  # frequent words were met early
            self.known = dict(itertools.islice(self.known.items(), MEMORY // 2))
        found = [list(map(self.known.get, words)) for words in lists]
        gaps = [list(itertools.compress(itertools.count(), map(operator.is_, ids, itertools.repeat(None)))) for ids in found]
        new = {words[at] for words, places in zip(lists, gaps) for at in places}
        if new:
            self._learn(list(new))
            for words, ids, places in zip(lists, found, gaps):
                for at in places:
                    ids[at] = self.known[words[at]]
            for w in new:
                if len(w) > LONGEST:
                    del self.known[w]
        return [b"".join(ids) for ids in found]

    def _long(self, data: bytes) -> Iterator[bytes]:
        start, ascii_only = 0, data.isascii()
        while start < len(data):
            cut = _SPACE.search(data, start + BLOCK) if len(data) - start > BLOCK else None
            end = cut.end() if cut else len(data)
            yield self._encoded([self._words(data[start:end], ascii_only)])[0]
            start = end

    def streams(self, texts: Iterable[str]) -> Iterator[Iterable[bytes]]:
        """For every text its ids as little-endian 32-bit numbers, in one piece or, if it is long, block after block."""
        held, size = [], 0
        for text in texts:
            data = text.encode()
            if size + len(data) > BLOCK:
                yield from ([ids] for ids in self._encoded(held))
                held, size = [], 0
            if len(data) > BLOCK:
                yield self._long(data)
            else:
                held.append(self._words(data, data.isascii()))
                size += len(data)
        yield from ([ids] for ids in self._encoded(held))


def word_ids(path: str) -> WordIds:
    """The encoder of a file, once per process."""
    if path not in _open:
        _open[path] = WordIds(path)
    return _open[path]
