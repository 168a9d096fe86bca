"""Benchmark decontamination: CGK walks, bit sampling and exact edit verification.

A passage is a benchmark leak when some window of a document lies within ``MAX_EDITS`` (a share of
the item's length) of the item in edit distance, after lower-casing ASCII letters and reducing all
other ASCII characters to single spaces.

The CGK embedding walks over a text: step j copies the current byte and goes on to the next byte or stays, as a
random bit for (j, byte) says. Texts that differ by few edits fall into step again, so edit distance becomes
Hamming distance, for which sampled places of the walk are a locality-sensitive hash. Only the part of a walk after an
edit is at risk, so walks are short and begin afresh at every word; how much of one is read goes by the item's length (``WALKS``):
a window is met if the walk from any one of the item's words agrees in all sampled places, in any of ``REPEATS``
independent walks. Target: nine in ten of the windows at the limit of edits (tested by length, walks alone).

Walks miss some leaks whatever their number, so exact pieces are added for the rest. An item that may have k edits
is cut into k + 1 pieces. One edit spoils one piece at most, so every window within k edits holds one of them
unchanged: no leak is lost (tested against brute force by length). A piece is looked up by its first bytes, at most
``WIDEST``, at every byte of a document, so scripts without spaces are met too.

Every candidate (window, item) is verified exactly: equal windows at once, the others by Myers' bit
vector algorithm over the window with the slack that the edits allow, unless the window holds fewer
of the item's runs of ``RUN`` bytes than must be left whole by the allowed edits (a run counts as often as the
item has it, so a word repeated all over does not pass). The runs of many windows are first counted together by
hashes, which can only count too many. Whole texts of all documents
are read in one pass over the bytes of Arrow batches; nothing is shuffled, and a passage in a third
of the documents costs each its own verification. Items are handed to the tasks in blocks of
``BLOCK_ITEMS``, whose size bounds what is broadcast; more items take more passes.

Defined results: null and empty texts and items are never leaks; items under ``MIN_ITEM`` bytes leak
as exact copies between word boundaries only (scripts without spaces have none); repeated rows and items are each reported; among windows of the same
distance the first is reported; a null ``doc_id`` stays null; an empty table gives no rows; other
columns are ignored by ``leaks`` and kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.buffers import joined, pieces, texts_in
from salesmart.llm.common import text_of

MAX_EDITS = 0.10
#: Most bytes of a piece that are looked up, and the least bytes of an item that may be edited.
WIDEST, MIN_ITEM = 16, 20
RUN = 6
BLOCK_ITEMS = 10_000
#: Independent walks; least bytes of an item and the steps that it is asked by, and how many of the steps up to
#: there are sampled. The kinds of items read one walk, a long item more of it.
REPEATS = 2
WALKS = ((MIN_ITEM, 12, 10), (64, 20, 14), (128, 28, 18))
SEED = 20_240
STARTS_AT_ONCE = 1 << 16
BYTES_AT_ONCE = 1 << 20
#: Places that are hashed, candidates that are held and bytes of windows whose runs are counted together.
PLACES_AT_ONCE, CANDIDATES_AT_ONCE, WINDOWS_AT_ONCE = 1 << 18, 1 << 18, 1 << 20
RUN_BITS = 12
_ODD = 0x9E3779B97F4A7C15
LEAKS = "doc_id long, item_id long, start long, end long, distance long, item_length long"

_FORM = np.arange(256, dtype=np.uint8)
_FORM[:128] = [b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(128)]


def normal_form(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes in the compared form, and where each stood."""
    form = _FORM[data]
    blank = form == 32
    kept = np.flatnonzero(~(blank & np.r_[True, blank[:-1]])) if len(form) else np.zeros(0, np.int64)
    return form[kept], kept


def runs(form: np.ndarray) -> np.ndarray:
    """The ``RUN`` bytes from every place as one number (fewer places than bytes)."""
    n = max(0, len(form) - RUN + 1)
    out = np.zeros(n, dtype=np.int64)
    for k in range(RUN):
        out = out << 8 | form[k:k + n]
    return out


def _keys(form: np.ndarray, widths: list[int]) -> Iterator[np.ndarray]:
    """For each of ``widths`` (ascending) a hash of so many bytes from every place (fewer places than bytes). A
    wider hash goes on from the one before."""
    data = form.astype(np.uint64)
    key = np.zeros(len(form) + 1, dtype=np.uint64)
    for k in range(widths[-1] if widths else 0):
        key = key[:max(0, len(form) - k)]
        key += data[k:]
        key *= np.uint64(_ODD)
        if k + 1 in widths:
            yield key ^ key >> np.uint64(32)


def _run_hash(run: np.ndarray) -> np.ndarray:
    out = np.empty(len(run), dtype=np.uint16)
    for k in range(0, len(run), PLACES_AT_ONCE):
        some = run[k:k + PLACES_AT_ONCE].astype(np.uint64)
        out[k:k + PLACES_AT_ONCE] = some * np.uint64(_ODD) >> np.uint64(64 - RUN_BITS)
    return out


class Walk:
    """One random walk and the hash of its sampled places."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.moves = rng.integers(0, 2, (WALKS[-1][1], 256), dtype=np.int64)
        self.sampled, before = set(), (0, 0)
        for _, steps, samples in WALKS:
            self.sampled |= set((before[0] + rng.choice(steps - before[0], samples - before[1], replace=False)).tolist())
            before = steps, samples
        self.factor = np.uint64(int(rng.integers(1, 1 << 62)) * 2 + 1)

    def keys(self, form: np.ndarray, starts: np.ndarray, lengths: list[int]) -> list[np.ndarray]:
        """For each of ``lengths`` (steps, ascending) the hash from every start in ``form`` (bytes as machine
        words, which numpy looks up without a copy), which goes on for at least so many bytes after the last."""
        at = starts.copy()
        key = np.zeros(len(at), dtype=np.uint64)
        out = []
        for step in range(lengths[-1]):
            byte = form.take(at, mode="clip")
            if step in self.sampled:
                key += byte.view(np.uint64)
                key *= self.factor
            if step + 1 in lengths:
                out.append(key ^ key >> np.uint64(32))
            at += self.moves[step].take(byte, mode="clip")
        return out


def word_starts(form: np.ndarray) -> np.ndarray:
    return np.flatnonzero((form != 32) & np.r_[True, form[:-1] == 32]) if len(form) else np.zeros(0, np.int64)


def _sorted(key: np.ndarray, item: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, ...]:
    """A lookup table: keys in order with their items and offsets, and which low key bits occur."""
    order = np.argsort(key, kind="stable")
    marks = np.zeros(1 << 20, dtype=bool)
    marks[(key & np.uint64(0xFFFFF)).astype(np.int64)] = True
    return key[order], item[order], offset[order], marks


class Index:
    """Keys of the walks and of the pieces of a block of items; without ``exact``, of the walks alone."""

    def __init__(self, items: list[tuple[int | None, str]], max_edits: float, exact: bool = True):
        self.max_edits = max_edits
        self.ids, self.forms = [], []
        for item_id, text in items:
            form = normal_form(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8))[0]
            form = form[:len(form) - (len(form) > 0 and form[-1] == 32)]
            if len(form) < MIN_ITEM:
                form = form[int(len(form) > 0 and form[0] == 32):]
            if len(form):
                self.ids.append(item_id)
                self.forms.append(form)
        self.most = np.array([int(max_edits * len(f)) * (len(f) >= MIN_ITEM) for f in self.forms], np.int64)
        self.walks = []
        kind = np.searchsorted([least for least, *_ in WALKS], [len(f) for f in self.forms], side="right") - 1
        self.steps = [steps for k, (_, steps, _) in enumerate(WALKS) if (kind == k).any()]
        for r in range(REPEATS if self.steps else 0):
            walk = Walk(SEED + r)
            self.walks.append((walk, [self._walked(walk, np.flatnonzero(kind == k).tolist(), steps)
                                      for k, (_, steps, _) in enumerate(WALKS) if steps in self.steps]))
        widths: dict[int, list[int]] = {}
        for i, form in enumerate(self.forms if exact else []):
            widths.setdefault(max(1, min(WIDEST, len(form) // (int(self.most[i]) + 1))), []).append(i)
        self.pieces = [(width, *self._entries(width, mine)) for width, mine in sorted(widths.items())]

    def _walked(self, walk: Walk, items: list[int], steps: int) -> tuple[np.ndarray, ...]:
        keys, item, offset = [], [], []
        for i in items:
            form = self.forms[i]
            # a walk that left the item would read what follows in the document
            starts = word_starts(form)
            starts = starts[starts <= max(0, len(form) - steps)]
            keys += walk.keys(np.r_[form, np.full(steps + 1, 32)].astype(np.int64), starts, [steps])
            item.append(np.full(len(starts), i, np.int64))
            offset.append(starts)
        return _sorted(np.concatenate(keys), np.concatenate(item), np.concatenate(offset))

    def _entries(self, width: int, items: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        keys, item, offset = [], [], []
        for i in items:
            # where the pieces begin: the shortest has ``width`` bytes at least
            n = int(self.most[i]) + 1
            starts = np.minimum(np.arange(n) * len(self.forms[i]) // n, len(self.forms[i]) - width)
            keys.append(next(_keys(self.forms[i], [width]))[starts])
            item.append(np.full(n, i, np.int64))
            offset.append(starts)
        return _sorted(np.concatenate(keys), np.concatenate(item), np.concatenate(offset))

    def candidates(self, form: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Lots of (item, place where it would begin, place of the word or piece that met). The item may begin
        before the text of that place: then its first bytes are missing."""
        padded = np.r_[form, np.full(max(self.steps, default=0) + 1, 32)].astype(np.int64)
        starts = word_starts(form) if self.walks else np.zeros(0, np.int64)
        held, size = [], 0
        for k in range(0, len(starts), STARTS_AT_ONCE):
            some = starts[k:k + STARTS_AT_ONCE]
            for walk, tables in self.walks:
                for key, table in zip(walk.keys(padded, some, self.steps), tables):
                    for which, met in self._met(key, table):
                        held.append((table[1][which], some[met] - table[2][which], some[met]))
                        size += len(met)
                        if size >= CANDIDATES_AT_ONCE:
                            yield tuple(map(np.concatenate, zip(*held)))
                            held, size = [], 0
        if held:
            yield tuple(map(np.concatenate, zip(*held)))
        widths = [width for width, *_ in self.pieces]
        for k in range(0, len(form), PLACES_AT_ONCE):
            for key, (_, *table) in zip(_keys(form[k:k + PLACES_AT_ONCE + widths[-1] - 1] if widths else form, widths),
                                        self.pieces):
                for which, met in self._met(key[:PLACES_AT_ONCE], table):
                    yield table[1][which], k + met - table[2][which], k + met

    @staticmethod
    def _met(key: np.ndarray, table: list | tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Lots of (entry of the table, place of the key that equals its)."""
        keys, _, _, marks = table
        maybe = np.flatnonzero(marks[(key & np.uint64(0xFFFFF)).astype(np.int64)])
        first = np.searchsorted(keys, key[maybe])
        n = np.searchsorted(keys, key[maybe], side="right") - first
        lot = np.cumsum(n) // CANDIDATES_AT_ONCE
        for some in np.split(np.arange(len(n)), np.flatnonzero(np.diff(lot)) + 1):
            m, total = n[some], int(n[some].sum())
            if total:
                yield (np.repeat(first[some], m) + np.arange(total) - np.repeat(np.cumsum(m) - m, m),
                       np.repeat(maybe[some], m))


def nearest(pattern: bytes, text: bytes, most: int) -> tuple[int, int] | None:
    """(distance, end) of the window of ``text`` that is nearest to ``pattern`` in edit distance, the
    first of equals; None beyond ``most``. Myers' algorithm with a column of the table in one number."""
    m = len(pattern)
    places: dict[int, int] = {}
    for i, b in enumerate(pattern):
        places[b] = places.get(b, 0) | 1 << i
    all_, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = all_, 0, m, None
    for j, b in enumerate(text):
        eq = places.get(b, 0)
        v = eq | minus
        h = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | ~(h | plus) & all_, plus & h
        score += (up & top > 0) - (down & top > 0)
        up, down = (up << 1) & all_, (down << 1) & all_
        plus, minus = down | ~(v | up) & all_, up & v
        if score <= most and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


def _spaced(char: str) -> bool:
    """Whether a letter or digit belongs to a script that sets blanks between words."""
    c = ord(char)
    return char.isalnum() and not (0xE00 <= c < 0xF00 or 0x1000 <= c < 0x10A0 or 0x1780 <= c < 0x1800
                                   or 0x3000 <= c < 0xA000 or 0xF900 <= c < 0xFB00 or c >= 0x20000)


def bounded(form: bytes, begin: int, end: int) -> bool:
    """Whether the window neither begins nor ends inside a word."""
    def chars(a: int, b: int) -> str:
        return form[max(0, a):b].decode("utf-8", "ignore")
    before, head = chars(begin - 4, begin)[-1:], chars(begin, begin + 4)[:1]
    tail, after = chars(end - 4, end)[-1:], chars(end, end + 4)[:1]
    return not any(x and y and _spaced(x) and _spaced(y) for x, y in ((before, head), (tail, after)))


class Matcher:
    """Verified leaks of one text."""

    def __init__(self, index: Index):
        self.index = index
        self.texts = [f.tobytes() for f in index.forms]
        self.runs, self.often = zip(*(np.unique(runs(f), return_counts=True) for f in index.forms)) if self.texts else ((), ())
        # the last entry stands for places without a run
        self.known = np.zeros((len(self.texts), (1 << RUN_BITS) + 1), dtype=bool)
        for i, run in enumerate(self.runs):
            self.known[i, _run_hash(run)] = True
        self.pad = max((len(t) for t in self.texts), default=0) + 4 * int(index.most.max(initial=0)) + RUN

    def _hashed(self, run: np.ndarray) -> np.ndarray:
        none = np.full(self.pad, 1 << RUN_BITS, np.uint16)
        return np.concatenate([none, _run_hash(run), none])

    def _near(self, hashed: np.ndarray, items: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Whether the windows around ``begins`` (items in order) can hold the runs that the edits must
        leave whole; other texts' runs beside a window may count for it."""
        good = np.zeros(len(items), dtype=bool)
        edge = np.r_[0, np.flatnonzero(np.diff(items)) + 1, len(items)]
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            i = int(items[a])
            n, most = len(self.texts[i]), int(self.index.most[i])
            wide = max(1, n + 4 * most - RUN + 1)
            windows = np.ndarray((len(hashed) - wide + 1, wide), hashed.dtype, hashed, 0, 2 * hashed.strides)
            step = max(1, WINDOWS_AT_ONCE // n)
            for k in range(a, b, step):
                some = windows[begins[k:min(b, k + step)] - 2 * most + self.pad]
                good[k:min(b, k + step)] = (np.count_nonzero(self.known[i][some], axis=1)
                                            >= n - RUN + 1 - RUN * most)
        return good

    def _too_far(self, i: int, window: np.ndarray, most: int) -> bool:
        known = self.runs[i]
        at = np.minimum(np.searchsorted(known, window), len(known) - 1)
        met = np.bincount(at[known[at] == window], minlength=len(known))
        return np.minimum(met, self.often[i]).sum() < len(self.texts[i]) - RUN + 1 - RUN * most

    def best(self, form: bytes, run: np.ndarray, items: np.ndarray,
             begins: np.ndarray) -> dict[int, tuple[int, int, int]]:
        """Item to (distance, start, end) in ``form``, one text in compared form; ``run``: its runs."""
        out: dict[int, tuple[int, int, int]] = {}
        tried: set[tuple[int, int]] = set()
        for i, begin in sorted(zip(items.tolist(), begins.tolist()), key=lambda p: (p[0], p[1])):
            item = self.texts[i]
            n, most = len(item), int(self.index.most[i])
            if i in out and out[i][0] == 0:
                continue
            same = begin >= 0 and form[begin:begin + n] == item
            if n < MIN_ITEM and not (same and bounded(form, begin, begin + n)):
                continue
            if same:
                out[i] = (0, begin, begin + n)
                continue
            place = (i, begin // max(1, most))
            if place in tried:
                continue
            tried.add(place)
            lo, hi = max(0, begin - 2 * most), max(0, begin + n + 2 * most)
            if self._too_far(i, run[lo:max(0, hi - RUN + 1)], most):
                continue
            window = form[lo:hi]
            hit = nearest(item, window, most)
            if hit and (i not in out or hit[0] < out[i][0]):
                back = nearest(item[::-1], window[:hit[1]][::-1], hit[0])
                out[i] = (hit[0], lo + hit[1] - back[1], lo + hit[1])
        return out

    def _candidates(self, form: np.ndarray, run: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """(item, place where it would begin, row) of the windows that can be near."""
        hashed, kept = None, [np.zeros((3, 0), np.int64)]
        for items, places, met in self.index.candidates(form):
            hashed = self._hashed(run) if hashed is None else hashed
            of = np.searchsorted(edge, met, side="right") - 1
            # one window serves all that begin within the allowed edits from its own begin
            slot = (places - edge[of]) // np.maximum(1, self.index.most[items])
            order = np.lexsort((places, slot, of, items))
            found = np.stack([items, places, of, slot])[:, order]
            found = found[:3, np.r_[True, (np.diff(found[[0, 2, 3]]) != 0).any(axis=0)]]
            kept.append(found[:, self._near(hashed, found[0], found[1])])
        return np.concatenate(kept, axis=1)

    def texts_of(self, column: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, distance, start, end in code points) of every leak of a column of texts."""
        for first, part in pieces(column, BYTES_AT_ONCE):
            data, begin = joined(part, 1)             # a zero byte, in compared form a blank, before each
            form, kept = normal_form(data)
            # the byte before a text belongs to it, so a window may begin at its first word
            edge = np.searchsorted(kept, np.r_[begin[:-1] - 1, len(data)])
            run = runs(form)
            items, places, of = self._candidates(form, run, edge)
            for row in np.unique(of).tolist():
                mine = of == row
                text = form[edge[row]:edge[row + 1]].tobytes()
                for i, (distance, a, b) in self.best(text, run[edge[row]:edge[row + 1]], items[mine], places[mine] - edge[row]).items():
                    at = kept[edge[row] + np.array([a, b - 1])]
                    chars = np.cumsum((data[begin[row]:at[1] + 1] & 0xC0) != 0x80)
                    start = max(0, int(at[0] - begin[row]))
                    yield first + row, i, distance, int(chars[start]) - 1, int(chars[-1])


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                block: int = BLOCK_ITEMS) -> Iterator[list[tuple[int | None, str]]]:
    """The benchmark's items, a bounded number at a time."""
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    held = []
    for r in rows.where("text is not null").toLocalIterator():
        held.append((r.item_id, r.text))
        if len(held) == block:
            yield held
            held = []
    if held:
        yield held


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_edits: float = MAX_EDITS) -> DataFrame:
    """One row per document row and item that it leaks: the nearest window (code points of the text),
    its edit distance in compared form and the item's length there."""
    spark = docs.sparkSession
    rows = text_of(docs, id_col, text_col)
    out = spark.createDataFrame([], LEAKS)
    for block in item_blocks(items):
        shared = spark.sparkContext.broadcast(Index(block, max_edits))
        out = out.union(rows.mapInArrow(_reporting(shared), LEAKS))
    return out


def _reporting(shared):
    def run(batches):
        matcher = Matcher(shared.value)
        for batch in batches:
            ids = batch.column("doc_id")
            found = list(matcher.texts_of(batch.column("text")))
            if found:
                row, item, distance, start, end = zip(*found)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(row)), pa.array([matcher.index.ids[i] for i in item], pa.int64()),
                    pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(distance, pa.int64()),
                    pa.array([len(matcher.texts[i]) for i in item], pa.int64())],
                    names=["doc_id", "item_id", "start", "end", "distance", "item_length"])
    return run


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", max_edits: float = MAX_EDITS) -> DataFrame:
    """The rows of ``docs``, all columns, whose text leaks no item."""
    spark = docs.sparkSession
    for block in item_blocks(items):
        shared = spark.sparkContext.broadcast(Index(block, max_edits))
        docs = docs.mapInArrow(_filtering(shared, text_col), docs.schema)
    return docs


def _filtering(shared, text_col: str):
    def run(batches):
        matcher = Matcher(shared.value)
        for batch in batches:
            good = np.ones(batch.num_rows, dtype=bool)
            for row, *_ in matcher.texts_of(texts_in(batch, text_col)):
                good[row] = False
            yield batch.filter(pa.array(good))
    return run
