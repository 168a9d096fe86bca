"""Clustering, filter audit and merge replay against brute force and the tiktoken library."""

import hashlib
import random
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from salesmart.llm import bpe_replay, filter_audit, subvector_kmeans
from salesmart.llm.common import ship, stored
from salesmart.llm.tokens import tokenizer_path

RNG = random.Random(11)
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


# ---------------------------------------------------------------- clustering

def brute_clusters(rows, clusters=16, rounds=3, seed=1):
    kept = [(i, [int(np.floor(64 * float(np.float64(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) and abs(x) < 2.0 ** 56 for x in v)]
    first = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centres = [v for _, v in first[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for k in range(len(centres)):
            mine = [v for (_, v), o in zip(kept, own) if o == k]
            if mine:
                centres[k] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [(i, *near(v)) for i, v in kept]
    most = (1 << 63) - 1
    per = {k: sum(min(d, most) for _, d, o in found if o == k) for k in range(len(centres))}
    return [(i, k, min(d, most), min(per[k], most), min(sum(per.values()), most),
             hashlib.sha256(",".join(map(str, centres[k])).encode()).hexdigest()) for i, d, k in found]


def vectors(n):
    return [(i, [RNG.gauss(0, .13) for _ in range(64)]) for i in range(n)]


def clusters_of(spark, rows, kind="double", **options):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    df = df.select("vec_id", "embedding", F.lit(1).alias("v"), F.lit(2).alias("cluster"), F.lit(3).alias("h"))
    return [tuple(r) for r in subvector_kmeans.cluster(df, **options).collect()]


def bag(rows):
    return sorted(map(repr, rows))


def test_clusters(spark):
    odd = [(900, None), (901, [0.1] * 63), (902, [0.1] * 65), (903, [None] + [0.1] * 63), (904, [NAN] + [0.] * 63),
           (905, [INF] + [0.] * 63), (906, []), (907, [-INF] * 64)]
    rows = vectors(300) + odd
    rows += [(None, rows[0][1]), (None, None), rows[5], rows[5], (3, rows[7][1])]      # repeats, clashing ids
    assert bag(clusters_of(spark, rows)) == bag(brute_clusters(rows))


def test_clusters_of_few_equal_and_no_vectors(spark):
    few = vectors(5)
    assert bag(clusters_of(spark, few)) == bag(brute_clusters(few))
    same = [(i, [0.5] * 64) for i in range(40)]
    assert bag(clusters_of(spark, same)) == bag(brute_clusters(same))
    assert clusters_of(spark, [(1, None)]) == [] and clusters_of(spark, []) == []


def test_clusters_of_large_components(spark):
    rows = [(i, [x * 10.0 ** (i % 15) for x in v]) for i, v in vectors(60)] + [(99, [1e300] * 64), (98, [1e16] * 64)]
    assert bag(clusters_of(spark, rows)) == bag(brute_clusters(rows))


def test_clusters_are_the_same_in_chunks_and_blocks_of_any_size(spark):
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in vectors(200)]
    kept = subvector_kmeans.integers(spark.createDataFrame(rows, "vec_id long, embedding array<float>"),
                                     "vec_id", "embedding", 64, 64)
    centres = subvector_kmeans.starts(kept, 16, 1)
    want = None
    for block, chunk in ((1, 64), (2, 7), (4, 1000), (64, 50)):
        coded = subvector_kmeans.encode(kept, 64, block, chunk)
        assert max(len(r.ids) for r in coded.collect()) <= chunk
        last = subvector_kmeans.fit(coded, centres, 3, block)
        got = bag(tuple(r) for r in subvector_kmeans.assign(coded, last, block).collect())
        want = want or got
        assert got == want
    assert want == bag(r[:3] for r in brute_clusters(rows))


# ---------------------------------------------------------------- filter audit

def brute_audit(rows, labels):
    docs = [(d, t or "", p or "") for d, t, p in rows]
    fails = []
    for d, t, _ in docs:
        words = t.encode().split()
        f = set()
        f |= {"A"} if len(words) < 200 else set()
        f |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        f |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t) else set()
        f |= {"D"} if any(c in "#$%&*|" for c in t) else set()
        f |= {"E"} if d is not None and any(x is not None and x < d and u == t for x, u, _ in docs) else set()
        fails.append(f)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    out = []
    for part in {p for _, _, p in docs}:
        mine = [(d, f) for (d, _, p), f in zip(docs, fails) if p == part]
        shapley, rows_ = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [(d, f) for d, f in left if x in f]
                left = [(d, f) for d, f in left if x not in f]
                shapley[x] += len(gone)
                rows_.append((part, "".join(order), step, len(left), len(gone), sum(x in f for _, f in mine) - len(gone),
                              sum(f == {x} for _, f in mine), sum(d in good for d, _ in gone),
                              sum(d in toxic for d, _ in gone)))
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in rows_]
    return out


def prose(n, words, capitals=False, sign=""):
    return " ".join(("W" if capitals else "w") + str(RNG.randrange(words)) for _ in range(n)) + sign


def test_filter_audit(spark):
    texts = [prose(n, w, c, s) for n in (5, 199, 200, 260) for w in (40, 9000) for c in (False, True) for s in ("", " #")]
    texts += [None, "", " \t\n", "Ä" * 97 + "ABC", "Ä" * 96 + "ABCD", "word " * 40_000, texts[-1], texts[3], texts[3]]
    rows = [(i, t, ("en", "fr", None, "")[i % 4]) for i, t in enumerate(texts)]
    rows += [rows[7], rows[7], (None, texts[3], "en"), (None, None, None), (2, texts[9], "xx")]
    rows += [(500 + i, texts[20], "en") for i in range(300)]                           # one large group of copies
    labels = [(i, RNG.choice([0, 1, None]), RNG.choice([0, 1, None])) for i in range(0, 600, 2)]
    labels += [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, 2, True) for r in rows],
                                 "doc_id long, text string, lang string, copies long, failed int, good boolean").repartition(4)
    marks = spark.createDataFrame([(*r, 9) for r in labels], "doc_id long, quality int, toxic int, part int")
    got = filter_audit.audit(docs, marks).collect()
    assert len(got) == 600 * 4
    assert bag(tuple(r) for r in got) == bag(brute_audit(rows, labels))
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    bare = bag(tuple(r) for r in filter_audit.audit(docs, marks.limit(0)).collect())
    assert bare == bag(brute_audit(rows, []))


def test_positional_counts():
    rng = np.random.default_rng(3)
    counter, want = filter_audit.Counter(), np.zeros(32, dtype=np.int64)
    for n in (0, 1, 2, 3, 1000, 7):
        words, copies = rng.integers(0, 1 << 32, n, np.uint32), rng.integers(1, 1000, n)
        counter.add(words, copies)
        want += ((words[:, None] >> np.arange(32, dtype=np.uint32) & 1) * copies[:, None]).sum(axis=0)
    assert counter.counts() == want.tolist()
    assert all(len(level) <= 1 for level in counter.levels)


# ---------------------------------------------------------------- merge replay

@pytest.fixture(scope="module")
def library():
    ranks = bpe_replay.read_ranks(tokenizer_path(bpe_replay.VOCABULARY))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_merge_replay(spark, library):
    letters = "abcdefgh éüñß日本語ไทย😀\n\t'!1"
    texts = [None, "", " ", "  two  spaces\r\n  　 x", "we're you'LL 's", "<|endoftext|> text", "word " * 30_000,
             "x" * 60_000, "ab" * 20_000, " " * 5_000, "日本語" * 2_000, "é \x1c\x85​﻿"]
    texts += ["".join(RNG.choice(letters) for _ in range(RNG.randrange(300))) for _ in range(150)]
    rows = [(i, t, 1, b"x") for i, t in enumerate(texts)] + [(4, texts[4], 1, b"x"), (None, "null id", 1, b""), (None, None, 1, b"")]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids binary").repartition(3), "t-replay")
    want = [(d, np.array(library.encode_ordinary(t or ""), "<u4").tobytes()) for d, t, *_ in rows]
    got = [(r.doc_id, bytes(r.ids)) for r in bpe_replay.encode(docs).collect()]
    assert bag(got) == bag(want)
    back = [(r.doc_id, bytes(r.data)) for r in bpe_replay.decode(bpe_replay.encode(docs)).collect()]
    assert bag(back) == bag((d, (t or "").encode()) for d, t, *_ in rows)
    sums = [tuple(r) for r in bpe_replay.round_trip(docs).collect()]
    assert bag(sums) == bag((d, len(x) // 4, hashlib.sha256(x).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
                            for (d, t, *_), (_, x) in zip(rows, want))
    assert bpe_replay.round_trip(docs.limit(0)).count() == 0


def test_merge_replay_in_vocabularies_whose_splits_have_no_order():
    """Tokens of random ranks: a merge often makes a pair of lower rank than its own."""
    rng = random.Random(5)
    for _ in range(60):
        base = [bytes([b]) for b in range(256)]
        more = list({bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 7))) for _ in range(60)})
        rng.shuffle(more)
        ranks = {t: i for i, t in enumerate(base + more)}
        replay = bpe_replay.Replay(ranks, public_tokenizers.PATTERN)
        other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        texts = ["".join(rng.choice("abc ") for _ in range(rng.randrange(80))) for _ in range(20)]
        texts.append("".join(rng.choice("abc") for _ in range(400)))
        assert [np.frombuffer(x, "<u4").tolist() for x in replay.encode(texts)] == [other.encode_ordinary(t) for t in texts]
