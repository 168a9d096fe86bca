"""Centroid clustering of integer vectors over subvector dictionaries, exact in every digit.

Vectors are cut into blocks of ``BLOCK`` components. In each chunk of vectors every block has a
dictionary of its distinct subvectors, and a vector is stored as one code per block: nothing is
lost, and codes and dictionaries are written once. A round computes the squared distances of the
dictionaries' entries to the centroids' blocks, once for each entry, and a vector's distance is the
sum of its codes' entries. Neighbouring values repeat, so there are far fewer entries than vectors.

Dictionaries belong to a chunk, not to the corpus, so that no vector has to meet a dictionary in a
join and nothing grows with the data: a task holds one chunk at a time, rounds exchange one sum
for each centroid and component and task, and only the centroids reach the driver.

Arithmetic is exact: in 64 bits where the components allow it, else in unbounded integers.

Defined results: vectors of another length, or with a null, non-finite or (beyond +-2**62 after
scaling) unrepresentable component are left out; a vector without id takes part under an empty id
and may be a start; starts with equal hashes (repeated rows) follow in the order of their
components; fewer vectors than centroids give fewer centroids; ties go to the smaller number;
distances and their sums beyond a long are the greatest long; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import stored

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
BLOCK = 2
#: Vectors that share their dictionaries (64 bytes of codes each); also the bound of a code.
CHUNK = 8_192
#: Components up to this size cannot make a squared distance overflow 64 bits.
SMALL = 1 << 27
LARGEST = (1 << 63) - 1

ENCODED = "ids array<long>, codes binary, entries binary, sizes array<int>"
ASSIGNED = "vec_id long, cluster int, distance long"


def integers(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int, scale: int) -> DataFrame:
    """vec_id and v (array<long>) of the vectors that take part."""
    def fits(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(1 << 62) / scale)

    x = F.col(vector_col).cast("array<double>")
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("v"))
            .where((F.size("v") == dimensions) & F.forall("v", fits))
            .select("vec_id", F.transform("v", lambda c: F.floor(c * float(scale)).cast("long")).alias("v")))


def starts(kept: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors whose ids have the least hashes, at most ``clusters`` rows on the driver."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = kept.select(F.sha2(key, 256).alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    return np.array([r.v for r in first], dtype=object)


def encode(kept: DataFrame, dimensions: int, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """Chunks of vectors as codes and dictionaries (``ENCODED``): ``codes`` has a row of 16-bit codes
    for each vector, ``entries`` the blocks' distinct subvectors one after the other."""
    types = [pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.list_(pa.int32())]
    if chunk > 1 << 16 or dimensions % block:
        raise ValueError("codes have 16 bits, and blocks are of one length")

    def coded(ids: list, v: np.ndarray) -> pa.RecordBatch:
        codes, entries, sizes = [], [], []
        for at in range(0, dimensions, block):
            part = np.ascontiguousarray(v[:, at:at + block])
            _, first, code = np.unique(part.view(f"V{8 * block}").ravel(), return_index=True, return_inverse=True)
            codes.append(code.astype(np.uint16))
            entries.append(part[first])
            sizes.append(len(first))
        values = [ids], [np.stack(codes, 1).tobytes()], [np.concatenate(entries).tobytes()], [sizes]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(values, types)],
                                          names=["ids", "codes", "entries", "sizes"])

    def run(batches):
        ids, held, n = [], [], 0
        for b in batches:
            v = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            for at in range(0, len(v), chunk):
                ids += b.column("vec_id").slice(at, chunk).to_pylist()
                held.append(v[at:at + chunk])
                n += len(held[-1])
                while n >= chunk:
                    rows = np.concatenate(held)
                    yield coded(ids[:chunk], rows[:chunk])
                    ids, held, n = ids[chunk:], [rows[chunk:]], n - chunk
        if n:
            yield coded(ids, np.concatenate(held))

    return kept.mapInArrow(run, ENCODED)


def nearest(codes: np.ndarray, entries: list[np.ndarray], centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector and the squared distance; ``centroids`` holds Python integers."""
    small = all(abs(x) <= SMALL for x in (*centroids.ravel().tolist(), *(e.max() for e in entries), *(e.min() for e in entries)))
    kind = np.int64 if small else object
    centres, block = centroids.astype(kind), entries[0].shape[1]
    total = np.zeros((len(codes), len(centres)), dtype=kind)
    for b, entry in enumerate(entries):
        gap = entry.astype(kind)[:, None, :] - centres[None, :, b * block:(b + 1) * block]
        total += (gap * gap).sum(axis=2)[codes[:, b]]
    best = total.argmin(axis=1)
    return best, np.minimum(total[np.arange(len(best)), best], LARGEST).astype(np.int64)


def _chunks(batches, dimensions: int, block: int):
    """(ids, codes, entries by block) of every chunk."""
    for b in batches:
        for r in range(b.num_rows):
            codes = np.frombuffer(b.column("codes")[r].as_py(), np.uint16).reshape(-1, dimensions // block)
            entries = np.frombuffer(b.column("entries")[r].as_py(), np.int64).reshape(-1, block)
            sizes = b.column("sizes")[r].as_py()
            yield b.column("ids")[r].values, codes, np.split(entries, np.cumsum(sizes)[:-1])


def sums(encoded: DataFrame, centroids: np.ndarray, block: int = BLOCK) -> dict[int, tuple[int, list[int]]]:
    """Cluster to its number of vectors and their componentwise sum; at most clusters x components
    numbers reach the driver."""
    dimensions = centroids.shape[1]
    decimal = pa.decimal128(38, 0)

    def run(batches):
        n, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, object)
        for _, codes, entries in _chunks(batches, dimensions, block):
            best, _ = nearest(codes, entries, centroids)
            n += np.bincount(best, minlength=len(n))
            for k in np.unique(best).tolist():
                own = codes[best == k]
                for b, entry in enumerate(entries):     # how often each entry occurs, then its multiples
                    often = np.bincount(own[:, b], minlength=len(entry))
                    used = often > 0
                    small = used.any() and np.abs(entry[used]).max() <= SMALL
                    kind = np.int64 if small else object
                    total[k, b * block:(b + 1) * block] += (entry[used].astype(kind) * often[used].astype(kind)[:, None]).sum(axis=0)
        k, d = np.nonzero(np.repeat(n[:, None] > 0, dimensions, axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(k, pa.int32()), pa.array(d, pa.int32()), pa.array(n[k], pa.int64()),
             pa.array([int(x) for x in total[k, d]], decimal)], names=["k", "d", "n", "s"])

    rows = (encoded.mapInArrow(run, "k int, d int, n long, s decimal(38,0)").groupBy("k", "d")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
    found: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        found.setdefault(r.k, (r.n, [0] * dimensions))[1][r.d] = int(r.s)
    return found


def assign(encoded: DataFrame, centroids: np.ndarray, block: int = BLOCK) -> DataFrame:
    """``ASSIGNED`` for every vector."""
    dimensions = centroids.shape[1]

    def run(batches):
        for ids, codes, entries in _chunks(batches, dimensions, block):
            best, distance = nearest(codes, entries, centroids)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(best, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    return encoded.mapInArrow(run, ASSIGNED)


def fit(encoded: DataFrame, centroids: np.ndarray, rounds: int = ROUNDS, block: int = BLOCK) -> np.ndarray:
    """Centroids after the rounds: exact floors of the means; empty clusters stay."""
    for _ in range(rounds):
        centroids = centroids.copy()
        for k, (n, total) in sums(encoded, centroids, block).items():
            centroids[k] = [s // n for s in total]
    return centroids


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS,
            scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 1) -> DataFrame:
    """``ASSIGNED``, cluster_inertia, inertia and centroid_sha256 for every vector that takes part."""
    kept = integers(vectors, id_col, vector_col, dimensions, scale)
    centroids = starts(kept, clusters, seed)
    if not len(centroids):
        return kept.select("vec_id", F.lit(0).alias("cluster"), *(F.lit(0).cast("long").alias(c) for c in (
            "distance", "cluster_inertia", "inertia")), F.lit("").alias("centroid_sha256")).where("false")
    encoded = stored(encode(kept, dimensions), "kmeans-codes")
    centroids = fit(encoded, centroids, rounds)
    rows = stored(assign(encoded, centroids), "kmeans-assigned")
    whole = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    inertia = {r.cluster: int(r.s) for r in whole}                      # one row for each centroid
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    per = F.array(*(F.lit(min(inertia.get(k, 0), LARGEST)).cast("long") for k in range(len(centroids))))
    return rows.select("vec_id", "cluster", "distance", F.get(per, F.col("cluster")).alias("cluster_inertia"),
                       F.lit(min(sum(inertia.values()), LARGEST)).cast("long").alias("inertia"),
                       F.get(F.array(*map(F.lit, digests)), F.col("cluster")).alias("centroid_sha256"))
