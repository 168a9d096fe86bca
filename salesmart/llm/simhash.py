"""SimHash near-duplicates through Golay-code fuzzy keys.

A fingerprint has one bit for each bit position that is set in over half the hashes of the
text's word shingles. Two documents are linked when their fingerprints differ in at most
``MAX_BITS`` bits; linked documents form classes.

Candidate search. The 64 bits are cut into three segments, each padded to the 23 bits of the
binary Golay code, which is perfect: every 23-bit word lies within 3 bits of exactly one
codeword. The keys of a segment are the codewords that the segment and its one-bit neighbours
decode to, at most six. Segments that differ in up to two bits have a word between them that is
a neighbour of both, so they share a key. Four differing bits cannot put three or more into two
segments, so in at least two of the three segments the fingerprints share a key: joining on the
pairs of keys of two segments (24 bits) finds every link.

Join and verification run over one exchange of (key, fingerprint) by key, sorted. Fingerprints
that occur in many documents take part once. A small bucket is verified pair by pair; in a large
one a search takes every fingerprint out of the bucket as soon as one link to it is known, so a
class of m near copies gives m - 1 links and not their square. Buckets beyond ``WIDE_BUCKET``
are first split by the five blocks of bits of which linked fingerprints must agree in one.

Defined results: a null, empty or blank text has fingerprint zero and is linked like any other;
fewer words than a shingle are hashed as one; repeated rows keep their rows and share a class; a
null ``doc_id`` takes part but never names a class with another id in it; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import shuffle_partitions, stored, text_of
from salesmart.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))           # first bit, width
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
SMALL_BUCKET = 64
WIDE_BUCKET = 4096
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    import xxhash
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    end = np.cumsum([len(t) + 1 for t in tokens]) - 1
    start = np.r_[0, end[:-1] + 1]
    k = min(words, len(tokens))
    bounds = list(zip(start[:len(start) - k + 1].tolist(), end[k - 1:].tolist()))
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(bounds), HASHES_AT_ONCE):
        h = np.array([digest(joined[s:e], SEED) for s, e in bounds[at:at + HASHES_AT_ONCE]],
                     dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(
            axis=0, dtype=np.int64)
    bits = np.packbits((2 * ones > len(bounds)).astype(np.uint8), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_hash, fp (the 64 bits as a signed long) of every row."""
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, words) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"),
                                              pa.array(fp.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    return (text_of(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
            .mapInArrow(run, "doc_id long, text_hash long, fp long"))


@cache
def _error_of_syndrome() -> np.ndarray:
    """For each remainder of a 23-bit word by the generator, the at most three wrong bits."""
    table = np.zeros(1 << 11, dtype=np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(23), weight):
            error = sum(1 << b for b in bits)
            table[int(_syndrome(np.array([error]))[0])] = error
    return table


# Fixed value: generator polynomial of the binary Golay code.
GENERATOR = 0b101011100011


def _syndrome(x: np.ndarray) -> np.ndarray:
    x = x.copy()
    for bit in range(22, 10, -1):
        x ^= ((x >> bit) & 1) * (GENERATOR << (bit - 11))
    return x


def segment_keys(x: np.ndarray, width: int) -> np.ndarray:
    """(n, 6) distinct 12-bit codeword indices of each segment value, -1 where there are fewer."""
    near = x[:, None] ^ np.array([0, *(1 << b for b in range(width))], dtype=np.int64)[None, :]
    index = np.sort((near ^ _error_of_syndrome()[_syndrome(near)]) >> 11, axis=1)
    new = np.diff(index, axis=1, prepend=-1) != 0
    out = np.full((len(x), 6), -1, dtype=np.int64)
    row, _ = np.nonzero(new)
    out[row, (np.cumsum(new, axis=1) - 1)[new]] = index[new]
    return out


def bucket_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every fuzzy key of the fingerprints."""
    segments = [segment_keys(((fp >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64), w)
                for s, w in SEGMENTS]
    rows, keys = [], []
    for pair, (a, b) in enumerate(combinations(segments, 2)):
        both = (a[:, :, None] << 12 | b[:, None, :]).reshape(len(fp), -1)
        real = ((a >= 0)[:, :, None] & (b >= 0)[:, None, :]).reshape(len(fp), -1)
        rows.append(np.nonzero(real)[0])
        keys.append(both[real] | pair << 24)
    return np.concatenate(rows), np.concatenate(keys)


def _near(a: np.ndarray, b, bits: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= bits


def _run_ends(key: np.ndarray) -> np.ndarray:
    """For each place in a sorted array, the end of its run of equal keys."""
    last = np.flatnonzero(np.r_[key[1:] != key[:-1], True]) + 1
    return np.repeat(last, np.diff(last, prepend=0))


def spanning_links(fp: np.ndarray, bits: int) -> list[np.ndarray]:
    """Links that connect just what the links among all of ``fp`` connect."""
    out, left = [], np.arange(len(fp))
    while len(left):
        waiting, left = [left[0]], left[1:]
        while waiting and len(left):
            q = waiting.pop()
            near = _near(fp[left], fp[q], bits)
            if near.any():
                hit = left[near]
                out.append(np.stack([np.full(len(hit), fp[q]), fp[hit]]))
                waiting.extend(hit.tolist())
                left = left[~near]
    return out


def links_in(key: np.ndarray, fp: np.ndarray, bits: int, split: bool = True) -> list[np.ndarray]:
    """Links (2, n) among the fingerprints of each run of equal keys of a sorted array."""
    out = []
    if not len(key):
        return out
    end = _run_ends(key)
    size = np.diff(np.r_[0, np.unique(end)])
    size = np.repeat(size, size)
    at = np.flatnonzero((size > 1) & (size <= SMALL_BUCKET))
    step = 1
    while len(at := at[at + step < end[at]]):
        near = at[_near(fp[at], fp[at + step], bits)]
        if len(near):
            out.append(np.stack([fp[near], fp[near + step]]))
        step += 1
    for stop in np.unique(end[size > SMALL_BUCKET]):
        run = np.unique(fp[stop - size[stop - 1]:stop])
        if split and len(run) > WIDE_BUCKET:
            for s, w in BLOCKS:
                block = (run >> np.uint64(s)) & np.uint64((1 << w) - 1)
                order = np.argsort(block, kind="stable")
                out += links_in(block[order], run[order], bits, split=False)
        else:
            out += spanning_links(run, bits)
    return out


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) links between the distinct fingerprints of column ``fp``: enough of them to connect
    all that differ in at most ``max_bits`` (up to 4) bits."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the key pairs find links of at most 4 bits")

    def emit(batches):
        for b in batches:
            fp = np.asarray(b.column("fp")).view(np.uint64)
            for at in range(0, len(fp), 20_000):
                row, key = bucket_keys(fp[at:at + 20_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.astype(np.int32)), pa.array(fp[at:at + 20_000][row].view(np.int64))],
                    names=["key", "fp"])

    def verify(batches):
        key, fp = np.zeros(0, np.int32), np.zeros(0, np.uint64)
        for b in batches:
            if not b.num_rows:
                continue
            key = np.concatenate([key, np.asarray(b.column("key"))])
            fp = np.concatenate([fp, np.asarray(b.column("fp")).view(np.uint64)])
            cut = int(np.searchsorted(key, key[-1]))      # the last run may go on
            yield from pairs(links_in(key[:cut], fp[:cut], max_bits))
            key, fp = key[cut:], fp[cut:]
        yield from pairs(links_in(key, fp, max_bits))

    def pairs(found):
        if found:
            both = np.unique(np.sort(np.concatenate(found, axis=1), axis=0), axis=1).view(np.int64)
            for at in range(0, both.shape[1], 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both[0, at:at + 50_000]), pa.array(both[1, at:at + 50_000])], names=["a", "b"])

    keyed = fps.mapInArrow(emit, "key int, fp long")
    return (keyed.repartition(shuffle_partitions(fps.sparkSession), "key")
            .sortWithinPartitions("key", "fp").mapInArrow(verify, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, text_hash, fp, root (a fingerprint of the class) and component_id (the least id
    reachable over links) of every row."""
    prints = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    root = components(links(distinct.select("fp"), max_bits), "a", "b")
    placed = (distinct.join(root, F.col("fp") == F.col("node"), "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    named = placed.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id"))
    classes = stored(placed.join(named, F.col("root") == F.col("r")).select("fp", "root", "component_id"),
                     "simhash-classes")
    return prints.join(classes, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
             max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, all columns, of which each class keeps one: that with the least id, of
    rows with that id the one with the least hash of its text, of whole repeats any."""
    placed = stored(near_duplicates(docs, id_col, text_col, words, max_bits)
                    .groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n")), "simhash-rows")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "n")
    best = (placed.groupBy(F.col("root").alias("r")).agg(F.min(order).alias("best"))
            .select("r", "best.doc_id", "best.text_hash", "best.n"))
    # classes of one row keep it; only the others are worth a list
    left_out = stored(placed.join(best.select("r", F.col("doc_id").alias("i"), F.col("text_hash").alias("h")),
                                  F.col("root") == F.col("r"))
                      .where(~F.col("doc_id").eqNullSafe(F.col("i")) | (F.col("text_hash") != F.col("h")))
                      .select(F.col("doc_id").alias("__i"), F.col("text_hash").alias("__h")), "simhash-left-out")
    repeated = stored(best.where("n > 1").select(F.col("doc_id").alias("__i"), F.col("text_hash").alias("__h")),
                      "simhash-repeated")
    rows = docs.withColumns({"__id": F.col(id_col).cast("long"), "__hash": F.xxhash64(
        F.coalesce(F.col(text_col).cast("string"), F.lit("")))})
    same = F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__hash") == F.col("__h"))
    kept = rows.join(left_out, same, "left_anti")
    if not repeated.isEmpty():
        kept = kept.join(repeated, same, "left_anti").union(
            kept.join(repeated, same, "left_semi").dropDuplicates(["__id", "__hash"]))
    return kept.select(*docs.columns)
