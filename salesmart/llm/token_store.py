"""Token-id shards on disk with a minimal perfect hash index for keyed access.

Shard file (all numbers little-endian)::

    ids of document 1, end id, ids of document 2, end id, ...     16 bits each, key order
    index arrays, JSON header, length of arrays and header (8 bytes), magic (8 bytes)
    end id

The payload is nothing but ids. Each row of the writing job is one document without its end
id; the text sink's record separator *is* the end id's bytes, so Spark's own committed,
retry-safe file output lays the payload down, in whatever store the path names. The last row
of a shard is its index.

Index: a cascade of bit arrays. A key goes to one place in the first array; the keys that meet
no other there own their bit, the others go on to the next, smaller array under another hash.
The number of set bits before a key's bit is its slot, so n keys have exactly the slots 0 to
n - 1. A slot keeps a 32-bit fingerprint (a foreign key is told apart with probability
1 - 2**-32), the place of the document in the payload and its key. Looking a key up costs a
constant expected number of probes and one slice of the payload.

Rows are put in key order by a range exchange of the texts; tokens are made after it, so they
are made once and never shuffled. The number of shards follows the bytes of text.

Defined results: repeated keys are numbered (copy 0, 1, ...) in the order of their texts and
each keeps its row; null keys come first, numbered likewise; a null or empty text is its end id
alone; an empty table writes no shard and reads as no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm.common import stored, text_of
from salesmart.llm.tokens import encode_batches, tokenizer_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
SHARD_BYTES = 32 << 20
#: Places per key in each bit array; more makes the index larger and lookups shorter.
GAMMA = 2.0
MAX_LEVELS = 200
MAGIC = b"IDSHARD1"
LOOKUP_KEYS = 100_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(doc_id: np.ndarray, missing: np.ndarray, copy: np.ndarray) -> np.ndarray:
    """64-bit hash of a document key; a missing id differs from every present one."""
    with np.errstate(over="ignore"):
        h = _mix(doc_id.astype(np.int64).view(np.uint64) + _GOLDEN)
        h = _mix(h + copy.astype(np.uint64) * _GOLDEN + np.uint64(1))
        return np.where(missing, _mix(copy.astype(np.uint64) * _GOLDEN + np.uint64(0x5EED)), h)


def fingerprint(h: np.ndarray) -> np.ndarray:
    return (_mix(h ^ np.uint64(0xF1A6)) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit values."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        counts = np.bitwise_count(bits).astype(np.int64)
        self.before = np.cumsum(counts) - counts
        self.first = np.cumsum(sizes) - sizes

    @classmethod
    def build(cls, h: np.ndarray) -> "PerfectHash":
        sizes, arrays, left = [], [], h
        while len(left):
            if len(sizes) == MAX_LEVELS:
                raise ValueError("keys are not distinct")
            m = -(-int(GAMMA * len(left) + 1) // 64) * 64
            at = cls._place(left, len(sizes), m)
            alone = np.bincount(at, minlength=m)[at] == 1
            taken = np.zeros(m, dtype=np.uint8)
            taken[at[alone]] = 1
            sizes.append(m)
            arrays.append(np.packbits(taken, bitorder="little"))
            left = left[~alone]
        return cls(np.array(sizes, dtype=np.int64),
                   np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.uint8))

    @staticmethod
    def _place(h: np.ndarray, level: int, m: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (_mix(h + np.uint64(level + 1) * _GOLDEN) % np.uint64(m)).astype(np.int64)

    def slots(self, h: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for a value that no array holds (surely foreign)."""
        out = np.full(len(h), -1, dtype=np.int64)
        open_ = np.arange(len(h))
        for level, (m, first) in enumerate(zip(self.sizes.tolist(), self.first.tolist())):
            if not len(open_):
                break
            at = first + self._place(h[open_], level, m)
            byte, bit = self.bits[at >> 3], (at & 7).astype(np.uint8)
            hit = (byte >> bit) & 1 == 1
            below = byte & ((np.uint16(1) << bit) - 1).astype(np.uint8)
            out[open_[hit]] = (self.before[at >> 3] + np.bitwise_count(below))[hit]
            open_ = open_[~hit]
        return out


def footer(doc_ids: list, lengths: list[int]) -> bytes:
    """Index of a shard whose documents, in order, have these keys and numbers of ids."""
    missing = np.array([d is None for d in doc_ids], dtype=bool)
    ids = np.array([0 if d is None else d for d in doc_ids], dtype=np.int64)
    new = np.r_[True, (ids[1:] != ids[:-1]) | (missing[1:] != missing[:-1])]
    place = np.arange(len(ids))
    copy = place - np.maximum.accumulate(np.where(new, place, 0))
    h = key_hash(ids, missing, copy)
    index = PerfectHash.build(h)
    slot = index.slots(h)
    n = np.array(lengths, dtype=np.int64)
    by_slot = np.empty(len(n), dtype=np.int64)
    by_slot[slot] = place
    arrays = {"sizes": index.sizes, "bits": index.bits, "fingerprint": fingerprint(h)[by_slot],
              "offset": (np.cumsum(n) - n)[by_slot], "length": n[by_slot], "doc_id": ids[by_slot],
              "missing": missing[by_slot], "copy": copy[by_slot]}
    blob = b"".join(a.tobytes() for a in arrays.values())
    head = json.dumps([[k, a.dtype.str, len(a)] for k, a in arrays.items()]).encode()
    return (blob + head + len(head).to_bytes(8, "little")
            + (len(blob) + len(head) + 8).to_bytes(8, "little") + MAGIC)


class Shard:
    """One shard file's content, opened for keyed access."""

    def __init__(self, content: bytes):
        end = len(content) - 2
        if content[end - 8:end] != MAGIC:
            raise ValueError("not a token shard")
        size = int.from_bytes(content[end - 16:end - 8], "little")
        start = end - 16 - size
        head_len = int.from_bytes(content[end - 24:end - 16], "little")
        at = start
        for name, kind, n in json.loads(content[end - 24 - head_len:end - 24]):
            setattr(self, name, np.frombuffer(content, kind, n, at))
            at += n * np.dtype(kind).itemsize
        self.index = PerfectHash(self.sizes, self.bits)
        self.payload = content

    def find(self, doc_id: np.ndarray, missing: np.ndarray, copy: np.ndarray) -> np.ndarray:
        """Slots of the keys; -1 where the shard holds no such key."""
        h = key_hash(doc_id, missing, copy)
        slot = self.index.slots(h)
        held = slot >= 0
        held[held] = self.fingerprint[slot[held]] == fingerprint(h[held])
        return np.where(held, slot, -1)

    def ids(self, slot: int) -> np.ndarray:
        return np.frombuffer(self.payload, "<u2", int(self.length[slot]), 2 * int(self.offset[slot]))


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
          vocabulary: str | None = None, shard_bytes: int = SHARD_BYTES) -> None:
    """Tokenise every document and write the shards under ``path``, in ascending key order."""
    rows = text_of(docs, id_col, text_col)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))

    def run(batches):
        doc_ids, lengths = [], []
        for some, ids in encode_batches(batches, vocabulary or tokenizer_path(VOCABULARY), True):
            doc_ids += some
            lengths += [len(x) // 2 + 1 for x in ids]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["row"])
        if doc_ids:
            yield pa.RecordBatch.from_arrays([pa.array([footer(doc_ids, lengths)], pa.binary())],
                                             names=["row"])

    end = np.array([END_ID], "<u2").tobytes().decode("ascii")
    (rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, "row binary").select(F.col("row").cast("string").alias("value"))
     .write.option("lineSep", end).option("maxRecordsPerFile", 0).option("compression", "none")
     .text(path))


def _shard_files(spark: SparkSession, paths) -> DataFrame:
    return spark.read.format("binaryFile").load(paths).where("length > 0").select("path", "content")


def _batches(columns: dict, types: dict, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    table = pa.table([pa.array(v, types[k]) for k, v in columns.items()], names=list(columns))
    yield from table.to_batches(max_chunksize=rows)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored document, found through its shard's index: doc_id, copy, start (ids
    of all documents before it), n_tokens, ids_crc32 (of the ids in 32 bits), shard."""
    types = {"path": pa.string(), "doc_id": pa.int64(), "copy": pa.int64(), "offset": pa.int64(),
             "n_tokens": pa.int64(), "ids_crc32": pa.int64()}

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                s = Shard(content.as_py())
                order = np.argsort(s.offset, kind="stable")
                keys = s.doc_id[order], s.missing[order], s.copy[order]
                slot = s.find(*keys)
                if (slot != order).any():
                    raise ValueError(f"index of {name} does not lead to its documents")
                crc = [zlib.crc32(s.ids(k).astype("<u4").tobytes()) for k in slot.tolist()]
                yield from _batches({
                    "path": [name.as_py()] * len(slot),
                    "doc_id": np.ma.masked_array(keys[0], keys[1]).tolist(), "copy": keys[2],
                    "offset": s.offset[slot], "n_tokens": s.length[slot], "ids_crc32": crc}, types)

    rows = _shard_files(spark, path).mapInArrow(
        run, "path string, doc_id long, copy long, offset long, n_tokens long, ids_crc32 long")
    rows = stored(rows.withColumn("shard", F.regexp_extract("path", r"part-(\d+)", 1).cast("long"))
                  .drop("path"), "token-digests")
    # one row per shard file meets in this window, not one per document
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = (rows.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
            .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    return (rows.join(base, "shard")
            .select("doc_id", "copy", (F.col("base") + F.col("offset")).alias("start"), "n_tokens",
                    "ids_crc32", "shard"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """path, lowest and highest key of every shard."""
    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                s = Shard(content.as_py())
                ids = s.doc_id[~s.missing]
                yield from _batches({"path": [name.as_py()], "lo": [int(ids.min()) if len(ids) else None],
                                     "hi": [int(ids.max()) if len(ids) else None]},
                                    {"path": pa.string(), "lo": pa.int64(), "hi": pa.int64()})

    return _shard_files(spark, path).mapInArrow(run, "path string, lo long, hi long")


def lookup(spark: SparkSession, shards: DataFrame, keys: list[int]) -> DataFrame:
    """doc_id, copy and ids of the given documents, at most ``LOOKUP_KEYS`` in a call; keys that
    are not stored give no row. ``shards`` is the stored ``manifest``; only files whose key range
    holds a key are opened."""
    if len(keys) > LOOKUP_KEYS:
        raise ValueError(f"look up at most {LOOKUP_KEYS} keys in a call")
    wanted = np.unique(np.array(keys, dtype=np.int64))
    schema = "doc_id long, copy long, ids array<int>"
    asked = spark.createDataFrame([(int(k),) for k in wanted], "key long")
    paths = [r[0] for r in shards.join(F.broadcast(asked), F.expr("key between lo and hi"))
             .select("path").distinct().collect()]
    if not paths:
        return spark.createDataFrame([], schema)

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                s = Shard(content.as_py())
                copy, left = 0, wanted
                while len(left):
                    slot = s.find(left, np.zeros(len(left), bool), np.full(len(left), copy))
                    left, slot = left[slot >= 0], slot[slot >= 0]
                    for d, k in zip(left.tolist(), slot.tolist()):
                        yield from _batches({"doc_id": [d], "copy": [copy], "ids": [s.ids(k).tolist()]},
                                            {"doc_id": pa.int64(), "copy": pa.int64(),
                                             "ids": pa.list_(pa.int32())})
                    copy += 1

    return _shard_files(spark, paths).mapInArrow(run, schema)
