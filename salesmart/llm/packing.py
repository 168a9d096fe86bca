"""Cost-balanced packing of tokenised documents into fixed-length training sequences.

A piece of n tokens costs ``LINEAR * n + QUADRATIC * n * n``: the work of the dense layers
grows with the tokens, that of attention with the square of the piece (pieces do not attend to
one another). Whole multiples of the sequence length are cut off a document first; each fills
a sequence of its own. The remainders of a block of documents are then assigned in descending
order to the sequence that has the lowest cost so far among those with room for them. The
block opens just as many sequences as its tokens fill, and the tokens beyond the last full
sequence get sequences whose lengths are powers of two, so that nothing is padded. A remainder
that fits nowhere is cut: the largest room takes what it holds, and the rest is assigned again.

Documents are packed where they are read: a task tokenises its rows, packs blocks of a bounded
number of tokens and forgets them. No row is shuffled, so a hot source or a long text costs no
more than its own tokens, and a lost task is repeated from its input alone. ``sequence_id`` is
the task's partition number followed by a counter, unique but not gapless.

Defined results: a null or empty text is its end id alone; repeated rows and ties are packed
each by itself (ties by position in the block); a null ``doc_id`` stays null; an empty table
gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from salesmart.llm.common import text_of
from salesmart.llm.tokens import encode_batches, tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
SEQUENCE_TOKENS = 2048
END_ID = 1
#: Tokens packed together; 4 million take 8 MB as ids.
BLOCK_TOKENS = 4_000_000
#: Dense work per token against attention work per token pair.
LINEAR, QUADRATIC = 1.0, 1 / 4096

PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, "
          "offset long, sequence_tokens long, sequence_cost double, ids_crc32 long")


def cost(n):
    return LINEAR * n + QUADRATIC * n * n


def tail_lengths(tokens: int) -> list[int]:
    """Powers of two that sum to ``tokens``, largest first."""
    return [1 << b for b in range(tokens.bit_length() - 1, -1, -1) if tokens >> b & 1]


def assign(lengths: np.ndarray, size: int) -> Iterator[tuple[int, int, int, int]]:
    """(document index, start, length, sequence) of every piece; sequences count from 0."""
    n_seq = 0
    rest: list[tuple[int, int, int]] = []          # (-remaining tokens, document, start)
    for i, n in enumerate(lengths.tolist()):
        for k in range(n // size):
            yield i, k * size, size, n_seq
            n_seq += 1
        if n % size:
            rest.append((-(n % size), i, n - n % size))
    total = -sum(r[0] for r in rest)
    room = np.array([size] * (total // size) + tail_lengths(total % size), dtype=np.int64)
    spent = np.zeros(len(room))
    heapq.heapify(rest)                             # longest first, then by position
    while rest:
        n, i, start = heapq.heappop(rest)
        n = -n
        fits = np.flatnonzero(room >= n)
        if len(fits):
            s, take = int(fits[np.argmin(spent[fits])]), n
        else:
            s = int(np.argmax(room))
            take = int(room[s])
            heapq.heappush(rest, (take - n, i, start + take))
        room[s] -= take
        spent[s] += cost(take)
        yield i, start, take, n_seq + s


def pack_block(doc_ids: list, ids: list[bytes], first_sequence: int, size: int) -> tuple[dict, int]:
    """Columns of the block's pieces, and the sequence number after its last."""
    lengths = np.array([len(x) // 2 for x in ids], dtype=np.int64)
    pieces = np.array(list(assign(lengths, size)), dtype=np.int64).reshape(-1, 4)
    pieces = pieces[np.lexsort((pieces[:, 1], pieces[:, 0], pieces[:, 3]))]
    i, start, length, seq = pieces.T
    first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]]) if len(seq) else seq
    before = np.cumsum(length) - length
    which = np.cumsum(np.r_[0, seq[1:] != seq[:-1]]) if len(seq) else seq
    return {
        "doc_id": [doc_ids[k] for k in i.tolist()], "start": start, "length": length,
        "doc_tokens": lengths[i], "sequence_id": seq + first_sequence,
        "offset": before - before[first][which],
        "sequence_tokens": np.add.reduceat(length, first)[which] if len(seq) else length,
        "sequence_cost": np.add.reduceat(cost(length), first)[which] if len(seq) else length * 1.0,
        "ids": [ids[k][2 * s:2 * (s + n)] for k, s, n in zip(i.tolist(), start.tolist(), length.tolist())],
    }, first_sequence + (int(seq.max()) + 1 if len(seq) else 0)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         vocabulary: str | None = None, size: int = SEQUENCE_TOKENS, end_id: int = END_ID,
         block_tokens: int = BLOCK_TOKENS, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place and, if asked for, its ids (``ids``,
    little-endian unsigned 16-bit).

    Columns: ``PIECES``; ``start`` counts the document's ids before the piece, ``offset`` the
    sequence's ids before it; ``ids_crc32`` is the unsigned crc32 of the piece's ids as
    little-endian unsigned 32-bit integers.
    """
    schema = f"{PIECES}, ids binary" if with_ids else PIECES
    end = np.array([end_id], "<u2").tobytes()

    def run(batches):
        path = vocabulary or tokenizer_path(VOCABULARY)
        sequence = TaskContext.get().partitionId() << 40
        held_docs, held, tokens = [], [], 0
        for doc_ids, ids in encode_batches(batches, path, drops_space=False):
            held_docs += doc_ids
            held += [x + end for x in ids]
            tokens += sum(len(x) // 2 + 1 for x in ids)
            if tokens >= block_tokens:
                columns, sequence = pack_block(held_docs, held, sequence, size)
                yield _batch(columns, with_ids)
                held_docs, held, tokens = [], [], 0
        if held:
            yield _batch(pack_block(held_docs, held, sequence, size)[0], with_ids)

    return text_of(docs, id_col, text_col).mapInArrow(run, schema)


def _batch(columns: dict, with_ids: bool) -> pa.RecordBatch:
    ids = columns.pop("ids")
    columns["ids_crc32"] = [zlib.crc32(widened(x)) for x in ids]
    if with_ids:
        columns["ids"] = ids
    types = {"doc_id": pa.int64(), "ids": pa.binary(), "sequence_cost": pa.float64()}
    return pa.RecordBatch.from_arrays(
        [pa.array(v, type=types.get(k, pa.int64())) for k, v in columns.items()],
        names=list(columns))


def widened(ids: bytes) -> bytes:
    """16-bit ids as little-endian unsigned 32-bit ids."""
    return np.frombuffer(ids, "<u2").astype("<u4").tobytes()
