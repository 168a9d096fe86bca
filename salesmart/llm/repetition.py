"""Repetition rules: how much of a text lies in repeated word n-grams and repeated lines.

Each text is handled whole and alone, in one pass over its words. Words become numbers, numbers
become 64-bit values, and the hash of the windows of n words is rolled on from that of n - 1
words over the whole array. A text without a repeated window of n words has none of n + 1, so
clean texts stop early. For each n the rule measures the characters of all words that lie in a
window that occurred before (each word once); the repeated words of the base rule count the first
occurrence too. For short n-grams it measures the characters that the most frequent one takes.

Nothing is shuffled or kept between rows.

Defined results: a null or empty text has no words, all counts 0, and fails; ties and repeated
rows are judged each by itself; a null ``doc_id`` stays null; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesmart.llm.common import text_of

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WORDS = 8
#: Largest share of the word characters in n-grams that occurred before, as published.
COVERED = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share that the most frequent n-gram may take, and how often it must occur to count.
TOP = {2: 0.20, 3: 0.18, 4: 0.16}
TOP_COUNT = 3
MAX_LINE_SHARE = 0.20

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, dup_line_share double, "
          "covered_share double, top_share double, failed_rule string")
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_SPACE = " \t\n\v\f\r"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _numbers(words: list[bytes]) -> np.ndarray:
    """A fixed 64-bit value for each distinct word of the text."""
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.uint64, len(words))
    x = (ids + np.uint64(1)) * _MULTIPLIER
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _repeated(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which windows have an equal elsewhere, and which have one before them."""
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    later = np.zeros(len(h), dtype=bool)
    later[order[1:][same]] = True
    out = later.copy()
    out[order[:-1][same]] = True
    return out, later


def _covered(start: np.ndarray, n: int, total: int) -> np.ndarray:
    """Words that lie in a window of n words that begins at a marked place."""
    edge = np.zeros(total + 1, dtype=np.int64)
    at = np.flatnonzero(start)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return np.cumsum(edge)[:total] > 0


def measure(text: str) -> tuple:
    """The columns of ``SCHEMA`` after doc_id."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n_words = len(words)
    word_chars = len(text) - sum(text.count(c) for c in _SPACE)
    symbols = len(_SYMBOLS.findall(text))
    seen, dup_lines, dup_line_chars = set(), 0, 0
    for line in text.split("\n"):
        if not line.strip(_SPACE):
            continue
        if line in seen:
            dup_lines += 1
            dup_line_chars += len(line) - sum(line.count(c) for c in _SPACE)
        seen.add(line)
    repeat_words, covered_share, top_share, failed = 0, 0.0, 0.0, None
    line_share = dup_line_chars / max(word_chars, 1)
    if line_share > MAX_LINE_SHARE:
        failed = "lines"
    value = _numbers(words)
    chars = np.fromiter((len(w) for w in words), np.int64, n_words)
    if len(raw) != len(text):                       # code points, not bytes
        chars = np.fromiter((len(w.decode("utf-8", "surrogatepass")) for w in words), np.int64, n_words)
    ends = np.r_[0, np.cumsum(chars)]
    h = value
    for n in range(2, max(*COVERED, *TOP, REPEAT_WORDS) + 1):
        if n_words < n:
            break
        with np.errstate(over="ignore"):
            h = h[:-1] * _MULTIPLIER + value[n - 1:]
        repeated, later = _repeated(h)
        if not repeated.any():
            break
        if n in TOP:
            _, first, count = np.unique(h, return_index=True, return_counts=True)
            often = count >= TOP_COUNT
            size = ends[first[often] + n] - ends[first[often]]
            share = min(1.0, float((size * count[often]).max(initial=0)) / max(word_chars, 1))
            top_share = max(top_share, share)
            if share > TOP[n]:
                failed = failed or f"top_{n}"
        if n == REPEAT_WORDS:
            repeat_words = int(_covered(repeated, n, n_words).sum())
        if n in COVERED:
            share = float(chars[_covered(later, n, n_words)].sum()) / max(word_chars, 1)
            covered_share = max(covered_share, share)
            if share > COVERED[n]:
                failed = failed or f"covered_{n}"
    base_failed = n_words < MIN_WORDS or 100 * repeat_words > MAX_REPEAT_PERCENT * n_words
    return (n_words, word_chars, symbols, dup_lines, repeat_words, base_failed,
            not base_failed and failed is None, line_share, covered_share, top_share, failed)


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, shares and verdict of every row; columns as in ``SCHEMA``."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = {"double": pa.float64(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    types = [kinds[c.split()[1]] for c in SCHEMA.split(", ")]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            columns = zip(*(measure(t) for t in b.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types[1:]))], names=names)

    return text_of(docs, id_col, text_col).mapInArrow(run, SCHEMA)
