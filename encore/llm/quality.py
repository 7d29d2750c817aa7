"""Line-first cleaning: rules per line, then a verdict on what is left of the document."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import flushed, id_and_text

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_LOST_SHARE = 0.3
# phrases that mark a line as page furniture; a line with one of them goes if it has at most BOILERPLATE_WORDS words
BOILERPLATE = (
    "accept all cookies", "add to cart", "all rights reserved", "click here", "cookie policy", "enable javascript",
    "forgot your password", "javascript is disabled", "log in to", "lorem ipsum", "powered by", "privacy policy",
    "read more", "share this", "sign up for", "skip to content", "subscribe to our", "terms of service", "terms of use",
    "use cookies",
)
BOILERPLATE_WORDS = 30
TERMINAL = frozenset(".!?:;…。！？")
CLOSERS = "\"'”’»›)]}*_」』）】"  # what may stand after a closing mark
MAX_WRAP = 120  # characters; wider lines are not taken for wrapped ones
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_MARKS = re.compile(r"[^\w\s]")
_BREAKS = re.compile(r"(?:^|\s)(?:[|»>•·/]|::|->)(?=\s|$)")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text: str) -> list[str]:
    return [w for w in _SPACE.split(text) if w]


def base_signals(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text; a null text has none."""
    text = text or ""
    words = words_of(text)
    seen, doubled = set(), 0
    for line in text.split("\n"):
        if _SPACE.sub("", line):
            doubled += line in seen
            seen.add(line)
    repeated = 0
    if len(words) >= WINDOW:
        windows = list(zip(*[words[i:] for i in range(WINDOW)]))
        counts = Counter(windows)
        if len(counts) < len(windows):
            reach = 0
            for i, window in enumerate(windows):
                if counts[window] > 1:
                    repeated += i + WINDOW - max(i, reach)
                    reach = i + WINDOW
    return len(words), sum(map(len, words)), len(_SYMBOLS.findall(text)), doubled, repeated


def has_close(words: list[str]) -> bool:
    """True if some word ends with a closing mark, quotes and brackets after it aside."""
    return any(w[-1] in TERMINAL or (w[-1] in CLOSERS and w.rstrip(CLOSERS)[-1:] in TERMINAL) for w in words)


def continued(lines: list[str]) -> list[bool]:
    """For every line whether the next one continues it.

    It does if it starts with a small letter, or if the line was broken because of its width: its paragraph (lines
    without a blank one between them) has three lines or more, none wider than MAX_WRAP, and the next line's first word
    would have made this line wider than the paragraph's widest. A line with a mark that navigation uses by itself
    neither continues nor is continued.
    """
    out, start = [False] * len(lines), 0
    while start < len(lines):
        end = start
        while end < len(lines) and words_of(lines[end]):
            end += 1
        if end - start > 1:
            part = [_SPACE.sub(" ", line).strip(" ") for line in lines[start:end]]
            width = max(map(len, part))
            wrapped = len(part) > 2 and width <= MAX_WRAP
            plain = [not _BREAKS.search(line) for line in part]
            for i in range(len(part) - 1):
                first = part[i + 1].split(" ", 1)[0]
                small = first.lstrip("\"'“‘«(")[:1].islower()
                out[start + i] = plain[i] and plain[i + 1] and (small or wrapped and len(part[i]) + 1 + len(first) > width)
        start = end + 1
    return out


def closes_ahead(lines: list[str]) -> list[bool]:
    """For every line whether a closing mark stands in the lines that continue it."""
    follows, out, ahead = continued(lines), [False] * len(lines), False
    for i in range(len(lines) - 1, -1, -1):
        out[i] = follows[i] and ahead
        ahead = out[i] or has_close(words_of(lines[i]))
    return out


def line_fault(line: str, ahead: bool = False) -> str:
    """Empty, or the rule by which a line goes: navigation, punctuation or boilerplate.

    - navigation: at least three separators that stand alone, one for every three words or more;
    - punctuation: eight words or more, none of which ends with a closing mark, unless one stands ``ahead``, in the lines
      that continue this one; marks are over 15% of 40 or more characters; or one
      word makes up more than half of eight or more words, which no sentence does;
    - boilerplate: one of the fixed phrases in a line of at most 30 words.
    """
    words = words_of(line)
    if not words:
        return ""
    breaks = len(_BREAKS.findall(line))
    if breaks >= 3 and 3 * breaks >= len(words) - breaks:
        return "navigation"
    solid = sum(map(len, words))
    if len(words) >= 8 and not ahead and not has_close(words):
        return "punctuation"
    if solid >= 40 and 100 * len(_MARKS.findall(line)) > 15 * solid:
        return "punctuation"
    if len(words) >= 8 and 2 * max(Counter(words).values()) > len(words):
        return "punctuation"
    if len(words) <= BOILERPLATE_WORDS:
        low = line.lower()
        if any(phrase in low for phrase in BOILERPLATE):
            return "boilerplate"
    return ""


def judge(text: str | None, max_lost: float = MAX_LOST_SHARE) -> tuple:
    """All columns of :func:`clean` after doc_id, for one text."""
    n_words, chars, symbols, doubled, repeated = base_signals(text)
    failed = n_words < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n_words
    faults = {"navigation": 0, "punctuation": 0, "boilerplate": 0}
    kept_lines, lost = [], 0
    lines = (text or "").split("\n")
    for line, ahead in zip(lines, closes_ahead(lines)):
        fault = line_fault(line, ahead)
        if fault:
            faults[fault] += 1
            lost += len(words_of(line))
        else:
            kept_lines.append(line)
    clean_text = text if not lost else "\n".join(kept_lines)
    kept = not failed and lost <= max_lost * n_words
    return (
        n_words, chars, symbols, doubled, repeated, failed, kept, faults["navigation"], faults["punctuation"],
        faults["boilerplate"], lost, clean_text,
    )


def clean(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_lost: float = MAX_LOST_SHARE
) -> DataFrame:
    """One row per row of ``docs``: the base signals, the verdict, lines lost by rule and the text that is left.

    Every line is judged first (:func:`line_fault`), a sentence that runs over several lines by all of them; failing lines go; a document is kept if its base signals pass
    and at most ``max_lost`` of its words went with the lines. ``clean_text`` equals the text if no line fails. A
    null text has no words, so it fails and its clean_text is null; an empty text is like it. A null identifier
    stays null, repeated rows are judged each, an empty table gives no rows, other columns are not read. Texts are
    handled one by one, whole, so memory follows the longest text.
    """
    kind = docs.select(F.col(id_col).alias("doc_id")).schema[0].dataType

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        long = pa.int64()
        schema = pa.schema(
            [("doc_id", to_arrow_type(kind))]
            + [(n, long) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
            + [("base_failed", pa.bool_()), ("kept", pa.bool_())]
            + [(n, long) for n in ("n_navigation", "n_punctuation", "n_boilerplate", "lost_words")]
            + [("clean_text", pa.string())]
        )

        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0), batch.column(1)):
                    yield (doc_id.as_py(), *judge(text.as_py(), max_lost))

        yield from flushed(rows(), schema, weigh=lambda r: 100 + 2 * len(r[-1] or ""))

    return id_and_text(docs, id_col, text_col, null=None).mapInArrow(
        run,
        f"doc_id {kind.simpleString()}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean, n_navigation bigint, n_punctuation bigint, "
        "n_boilerplate bigint, lost_words bigint, clean_text string",
    )


def cleaned(
    docs: DataFrame, text_col: str = "text", length_col: str | None = None, max_lost: float = MAX_LOST_SHARE
) -> DataFrame:
    """The rows of ``docs`` that :func:`clean` keeps, all columns as they were but the text without its failing lines.

    ``length_col`` names a column with the text's length in code points, which then follows the text.
    """
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            step = max(1, batch.num_rows * (4 << 20) // max(batch.nbytes, 1))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                verdicts = [judge(text.as_py(), max_lost) for text in part.column(at)]
                texts = [v[-1] if v[6] else None for v in verdicts]
                part = part.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
                if length_col:
                    place = batch.schema.get_field_index(length_col)
                    field = batch.schema.field(place)
                    part = part.set_column(place, field, pa.array([len(t) if t else 0 for t in texts], field.type))
                yield part.filter(pa.array([v[6] for v in verdicts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
