"""Byte-level BPE by replaying the merges over a whole block of text at once, and decoding.

A block's texts are cut into words by the vocabulary's pattern, and its distinct words are laid out
as chains of single bytes. An inverted index leads from each merge (the rank of a pair of
neighbours) to the places where that pair stands, in any word. The merges are then replayed in rank
order: the places of a rank are merged from left to right, and only the two neighbours of a merged
place get a new rank and enter the index. So a merge costs what it touches, however many words
there are, and each distinct word is encoded once.

A pair's rank is the rank of its joined bytes. A merge may make a pair of lower rank than its own
(a vocabulary needs not list a token's every split in order): that pair comes next, and the rest of
that word waits for it, so ids are those of the rule "lowest rank first, leftmost first" in any
vocabulary. A word that is a token itself is that token.

Blocks are bounded and belong to one task; no row is shuffled. A worker remembers the ids of short
words up to ``KNOWN_WORDS``.

Defined results: a null or empty text has no ids and decodes to no bytes; special tokens' strings
are ordinary text; ties and repeated rows are encoded each by itself; a very long text or word is
encoded whole; a null ``doc_id`` stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesmart.llm.buffers import pieces, texts_in
from salesmart.llm.common import text_of
from salesmart.llm.tokens import tokenizer_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Bytes of text whose words are replayed together.
BLOCK_BYTES = 8 << 20
#: Words (of at most so many characters) that a worker remembers.
KNOWN_WORDS, KNOWN_CHARS = 1_000_000, 64

ENCODED = "doc_id long, ids binary"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


#: In place of a rank: the byte belongs to a token that begins before it.
MERGED = -2


def _places(rank: np.ndarray) -> dict[int, list[int]]:
    """The inverted index: places of each rank, ascending."""
    order = np.argsort(rank, kind="stable")
    order = order[np.searchsorted(rank, 0, sorter=order):]
    values, first = np.unique(rank[order], return_index=True)
    order = order.tolist()
    return {v: order[a:b] for v, a, b in zip(values.tolist(), first.tolist(), [*first[1:].tolist(), len(order)])}


class Replay:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        self.cut = regex.compile(pattern).findall
        self.ranks = ranks
        self.token = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.single = {t: np.array([r], "<u4").tobytes() for t, r in ranks.items()}
        self.byte = np.array([ranks[bytes([b])] for b in range(256)])
        self.pair = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)])
        self.known: dict[str, bytes] = {}

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit numbers; every single byte has to be a token."""
        rank_of, token = self.ranks.get, self.token
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        left = self.byte[data].tolist()                  # id of the token that begins here
        after = np.arange(1, len(data) + 1)              # where the next token of the word begins, or -1
        before = np.arange(-1, len(data) - 1)
        after[ends[ends > 0] - 1] = -1
        before[ends[ends < len(data)]] = -1
        rank = np.full(len(data), -1)                    # rank of the pair that begins here
        rank[:-1] = self.pair[data[:-1], data[1:]]
        rank[after < 0] = -1
        index = _places(rank)
        after, before, rank = after.tolist(), before.tolist(), rank.tolist()
        queue = list(index)
        heapq.heapify(queue)
        while queue:
            now = heapq.heappop(queue)
            waiting = -1                                 # end of a word that has a lower rank to merge first
            later = []
            for i in sorted(index.pop(now)):
                if rank[i] != now:                       # a neighbour was merged meanwhile
                    continue
                if i < waiting:
                    later.append(i)
                    continue
                j = after[i]
                k = after[i] = after[j]
                h = before[i]
                left[i] = now
                rank[j] = MERGED
                if k >= 0:
                    before[k] = i
                    r = rank[i] = rank_of(token[now] + token[left[k]], -1)
                    if r >= 0:
                        if r in index:
                            index[r].append(i)
                        else:
                            index[r] = [i]
                            heapq.heappush(queue, r)
                        if r < now:
                            waiting = int(ends[np.searchsorted(ends, i, "right")])
                else:
                    rank[i] = -1
                if h >= 0:
                    r = rank[h] = rank_of(token[left[h]] + token[now], -1)
                    if r >= 0:
                        if r in index:
                            index[r].append(h)
                        else:
                            index[r] = [h]
                            heapq.heappush(queue, r)
                        if r < now:
                            waiting = int(ends[np.searchsorted(ends, i, "right")])
            if later:
                index[now] = later
                heapq.heappush(queue, now)
        kept = np.array(rank, dtype=np.int64) != MERGED
        ids = np.array(left, dtype="<u4")[kept].tobytes()
        upto = (4 * np.r_[0, np.cumsum(kept)][np.r_[0, ends]]).tolist()
        return [ids[a:b] for a, b in zip(upto, upto[1:])]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of each word."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        whole = list(map(self.single.get, raw))
        rest = iter(self.replay([r for r, w in zip(raw, whole) if w is None]))
        return [next(rest) if w is None else w for w in whole]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        cut = [self.cut(t) for t in texts]
        new = list(set().union(*cut).difference(known))
        found = dict(zip(new, self._words(new)))
        known.update(found)
        out = [b"".join(map(known.__getitem__, words)) for words in cut]
        for w in new:
            if len(w) > KNOWN_CHARS:
                del known[w]
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_REPLAYS: dict[tuple[str, str], Replay] = {}


def replayer(path: str | None = None, pattern: str | None = None) -> Replay:
    """One for each worker process and vocabulary."""
    import public_tokenizers
    key = path or tokenizer_path(VOCABULARY), pattern or public_tokenizers.PATTERN
    if key not in _REPLAYS:
        _REPLAYS[key] = Replay(read_ranks(key[0]), key[1])
    return _REPLAYS[key]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit) of every row."""
    def run(batches):
        r = replayer(vocabulary, pattern)
        for b in batches:
            for first, part in pieces(texts_in(b, "text"), BLOCK_BYTES):
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(first, len(part)), pa.array(
                    r.encode(part.to_pylist()), pa.binary())], names=["doc_id", "ids"])

    return text_of(docs, id_col, text_col).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and data (bytes) of every row of ``encode``; null ids decode to null."""
    def run(batches):
        r = replayer(vocabulary, pattern)
        for b in batches:
            data = [None if x is None else r.decode(x) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return encoded.mapInArrow(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
               pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of what they decode to."""
    def run(batches):
        r = replayer(vocabulary, pattern)
        for b in batches:
            for first, part in pieces(texts_in(b, "text"), BLOCK_BYTES):
                ids = r.encode(part.to_pylist())
                columns = [[len(x) // 4 for x in ids], [hashlib.sha256(x).hexdigest() for x in ids],
                           [hashlib.sha256(r.decode(x)).hexdigest() for x in ids]]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(first, len(part)), *(pa.array(c, t) for c, t in zip(
                        columns, (pa.int64(), pa.string(), pa.string())))],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return text_of(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
