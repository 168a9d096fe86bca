"""Operators against brute force on small tables with nulls, empty and long texts, repeats, clashing
extra columns and no rows."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesmart.llm import (decontaminate, kneser_ney, license_scan, packing, pii, repetition, secret_scan, simhash,
                           spans, token_store, warc)
from salesmart.llm.common import scratch_path, ship, stored
from salesmart.llm.components import components
from salesmart.llm.tokens import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, row_no long, kind string"
RNG = random.Random(7)
WORDS = ["alpha", "beta", "gamma", "delta", "Épsilon", "zeta", "the", "of", "and", "theta", "iota", "kappa"]
PROSE = [" ".join(RNG.choice(WORDS) + str(RNG.randrange(99)) * (RNG.random() < .1) for _ in range(n))
         for n in (3, 25, 60, 400)]
TEXTS = [
    None, "", " \t\n ", *PROSE, PROSE[2], PROSE[3] + " one more", PROSE[1] + "\n" + PROSE[1] + "\n" + PROSE[1],
    "word " * 30_000, "x" * 60_000, "two  spaces   and\ttabs \n here", "<|endoftext|> 's we're ünïcode 😀 ﬁ ı",
    "Released under the MIT License.\nApache License, Version 2.0 and CC-BY nc",
    "This work is licensed under the GNU General Public License, version 3.",
    'token: secret: abcdefghijklmnop API_KEY = "abcdefghijkl" AKIA123 AKIA12345678901234Z deadbeefdeadbeef0x',
    "a@b.com_x@y.z.com 1.2.3.4.5.6.7.8 256.1.1.1 4111 1111 1111 1111 +1 (523) 555-1055 😀 q@r.st 0001.02.3.4",
    "5 " * 3_000 + "ab@c.de " * 2_000]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    rows = [(i, t, ("en", "fr", None)[i % 3], "s", 0, 1, 2, "k") for i, t in enumerate(TEXTS)]
    rows += [(3, TEXTS[3], "en", "s", 0, 1, 2, "k"), (None, PROSE[2], None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None)]
    return stored(spark.createDataFrame(rows, SCHEMA).repartition(3), "t-docs")


@pytest.fixture(scope="module")
def no_docs(spark, docs):
    return docs.limit(0)


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def bag(rows):
    return sorted(map(repr, rows))


def ids_of(name, text):
    t = Tokenizer.from_file(tokenizer_path(name))
    return t.encode(text, add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing(docs, no_docs):
    rows = packing.pack(docs).collect()
    by_text = {}
    for d, t in texts(docs):
        by_text.setdefault(d, []).append(ids_of("byte_bpe_50k.json", t))
    total = sum(len(x) for v in by_text.values() for x in v)
    assert sum(r.length for r in rows) == total
    for r in rows:
        assert any(len(x) == r.doc_tokens and crc(x[r.start:r.start + r.length]) == r.ids_crc32 for x in by_text[r.doc_id])
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at == 2048 or at & (at - 1) == 0           # nothing is padded
    assert packing.pack(no_docs).count() == 0


def test_packing_balances_cost():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 900, 400)
    pieces = list(packing.assign(lengths, 2048))
    spent = np.bincount([p[3] for p in pieces], [packing.cost(p[2]) for p in pieces])
    full = np.bincount([p[3] for p in pieces], [p[2] for p in pieces]) == 2048
    assert spent[full].max() / spent[full].min() < 1.35
    assert len(pieces) < 1.35 * len(lengths)


def test_token_store(spark, docs, no_docs):
    path = scratch_path(spark, "t-store")
    token_store.write(docs, path, shard_bytes=1 << 16)
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.copy, r.start, r.n_tokens, r.ids_crc32)
                  for r in token_store.read_digests(spark, path).collect()))
    start, want = 0, []
    for d, t in sorted(texts(docs), key=lambda p: (p[0] is not None, p[0] or 0, p[1])):
        ids = ids_of("word_bpe_49k.json", t)
        copy = sum(w[:2] == (d is not None, d or 0) for w in want)
        want.append((d is not None, d or 0, copy, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == sorted(want)
    shards = stored(token_store.manifest(spark, path), "t-manifest")
    found = token_store.lookup(spark, shards, [3, 5, 10 ** 12]).collect()
    assert sorted((r.doc_id, r.copy) for r in found) == [(3, 0), (3, 1), (5, 0)]
    assert all(r.ids == ids_of("word_bpe_49k.json", TEXTS[r.doc_id]) for r in found)
    empty = scratch_path(spark, "t-store")
    token_store.write(no_docs, empty)
    assert token_store.read_digests(spark, empty).count() == 0


def test_perfect_hash_is_minimal():
    h = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64))
    index = token_store.PerfectHash.build(h)
    assert sorted(index.slots(h).tolist()) == list(range(len(h)))
    assert len(index.bits) * 8 < 4 * len(h)


def brute_print(text):
    import xxhash
    w = text.encode().lower().split()
    grams = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    count = [sum(xxhash.xxh64_intdigest(g, 42) >> i & 1 for g in grams) for i in range(64)]
    return sum(1 << i for i in range(64) if 2 * count[i] > len(grams))


def test_simhash(docs, no_docs):
    rows = simhash.near_duplicates(docs).collect()
    got = bag((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in rows)
    prints = [(d, brute_print(t)) for d, t in texts(docs)]
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 4:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    least = {r: min((d for (d, _), q in zip(prints, root) if q == r and d is not None), default=None) for r in root}
    assert got == bag((d, f, least[r]) for (d, f), r in zip(prints, root))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root))
    assert simhash.near_duplicates(no_docs).count() == 0


def test_simhash_large_buckets():
    """Dense and sparse buckets beyond every limit connect what all pairs connect."""
    rng = np.random.default_rng(3)
    seed = rng.integers(0, 1 << 62, 30, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (30, 250, 2)).astype(np.uint64)
    fp = np.unique((seed[:, None] ^ flips[..., 0] ^ flips[..., 1]).ravel())
    assert len(fp) > simhash.WIDE_BUCKET

    def classes(links):
        root = {int(x): int(x) for x in fp}
        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in links:
            a, b = find(int(a)), find(int(b))
            root[max(a, b)] = min(a, b)
        return [find(int(x)) for x in fp]
    every = [(a, b) for i, a in enumerate(fp) for b in fp[i + 1:][np.bitwise_count(fp[i + 1:] ^ a) <= 4]]
    found = np.concatenate(simhash.links_in(np.zeros(len(fp), np.int32), fp, 4), axis=1).T
    assert classes(every) == classes(found) and len(found) < 20 * len(fp)


def test_golay_keys_meet():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 62, 3000, dtype=np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, 4, replace=False):
            y[i] ^= np.uint64(1) << np.uint64(b)
    (ra, ka), (rb, kb) = simhash.bucket_keys(x), simhash.bucket_keys(y)
    assert len({*(zip(ra.tolist(), ka.tolist()))} & {*zip(rb.tolist(), kb.tolist())}) >= len(x)
    assert {r for r, _ in {*zip(ra.tolist(), ka.tolist())} & {*zip(rb.tolist(), kb.tolist())}} == set(range(len(x)))


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components(chain, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_repetition(docs, no_docs):
    got = bag((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
              for r in repetition.repetition(docs).collect())
    want = []
    for d, t in texts(docs):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        at = {}
        for i in range(len(w) - 7):
            at.setdefault(tuple(w[i:i + 8]), []).append(i)
        inside = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)}
        want.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
                     len(inside), len(w) < 20 or 100 * len(inside) > 30 * len(w)))
    assert got == bag(want)
    kept = {r.doc_id: r.kept for r in repetition.repetition(docs).collect()}
    assert kept[5] and kept[6] and not kept[9] and not kept[10]
    assert repetition.repetition(no_docs).count() == 0


def test_repeats_are_measured_after_the_first():
    def text(length, times, of):
        passage = " ".join(f"p{i:03d}" for i in range(length))
        rest = [f"w{i:03d}" for i in range(of - length * times)]
        step = len(rest) // times
        return " ".join(" ".join([*rest[k * step:(k + 1) * step if k < times - 1 else None], passage]) for k in range(times))
    fields = [c.split()[0] for c in repetition.SCHEMA.split(", ")][1:]
    five = dict(zip(fields, repetition.measure(text(10, 5, 330))))     # 40 words of 330 after the first
    assert abs(five["covered_share"] - 40 / 330) < 0.01 and not five["kept"] and five["failed_rule"] == "covered_8"
    twice = dict(zip(fields, repetition.measure(text(25, 2, 330))))    # 25 words of 330
    assert abs(twice["covered_share"] - 25 / 330) < 0.01 and twice["kept"] and twice["n_repeat_words"] == 50


def brute_spans(text, rules):
    out = [(m.start(), rank, m.end(), kind) for rank, (kind, pattern, ok) in enumerate(rules)
           for m in re.finditer(pattern, text) if ok(m)]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def digits(m):
    return re.sub("[^0-9]", "", m.group())


def luhn(m):
    d = [int(c) for c in digits(m)][::-1]
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


SECRETS = [("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            lambda m: len(m.group(2)) >= 12),
           ("access", "AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 18),
           ("hex", "[0-9a-f]+", lambda m: len(m.group()) >= 16)]
PERSONAL = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.group().split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(m)),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15)]


def test_secrets_and_ledger(spark, docs, no_docs):
    ledger = scratch_path(spark, "t-ledger")
    base = F.filter("findings", lambda s: s["rank"] < 3)
    got = secret_scan.scan(docs, ledger).select("doc_id", spans.as_text(spans.ordered(base))).collect()
    assert bag(tuple(r) for r in got) == bag((d, brute_spans(t, SECRETS)) for d, t in texts(docs))
    n = spark.read.parquet(ledger).count()
    assert n == len({t for _, t in texts(docs)}) + 1                # a whole row is repeated
    secret_scan.update(docs, ledger)
    assert spark.read.parquet(ledger).count() == n                  # nothing was scanned again
    newer = tuple(secret_scan.Rule(r.kind, r.pattern, r.passes, 2) if r.kind == "hex" else r for r in secret_scan.RULES)
    again = secret_scan.scan(docs, ledger, rules=newer).select("doc_id", spans.as_text(spans.ordered(base))).collect()
    assert bag(map(tuple, again)) == bag(map(tuple, got))
    runs = spark.read.parquet(ledger).where("rules = array('hex@2')").count()
    assert runs == n                                                # only the new version ran
    clean = {r.doc_id: r.text for r in secret_scan.redact(docs, ledger).collect()}
    assert "abcdefghijkl" not in clean[16].replace("abcdefghijklmnop", "") and clean[5] == TEXTS[5]
    assert secret_scan.scan(no_docs, scratch_path(spark, "t-ledger")).count() == 0


def test_pii(spark, docs, no_docs):
    got = pii.extract(docs).select("doc_id", spans.as_text(F.col("base"))).collect()
    assert bag(map(tuple, got)) == bag((d, brute_spans(t, PERSONAL)) for d, t in texts(docs))
    assert pii.extract(no_docs).count() == 0


def test_pii_discovers_by_context(spark, docs):
    rows = [(i, f"please reach me at phone +1 (523) 555-10{i:02d} soon") for i in range(20)]
    rows += [(99, "or at phone 5235551099 today"), (98, "we saw 5235551098 of them")]
    got = {r.doc_id: r[1] for r in pii.extract(spark.createDataFrame(rows, "doc_id long, text string"))
           .select("doc_id", spans.as_text(F.col("spans"))).collect()}
    assert got[99] == "phone_context:12:22" and got[98] == ""


def test_pii_discovers_every_shape(spark):
    cards = [n for n in range(4111111111110000, 4111111111119999) if luhn(re.match(".*", str(n)))][:20]
    seen = {"mail": [f"a{i}.b@mail.example.com" for i in range(20)], "call": [f"+1 (523) 555-10{i:02d}" for i in range(20)],
            "card": [str(n) for n in cards], "host": [f"10.0.0.{i}" for i in range(20)]}
    rows = [(i, f"now {word} {x} soon") for i, (word, x) in enumerate((w, x) for w, v in seen.items() for x in v)]
    new = {"mail jane@intranet, or": "email_context:5:18", "call 555 123 4567. or": "phone_context:5:17",
           "call (523) 555-1099, or": "phone_context:5:19", "card 4111 1111 1111 1112 or": "card_context:5:24",
           "host fe80::1:2f or": "ip_context:5:15", "mail 5235551099 or": "", "call jane@intranet or": "",
           "call 555\n123 4567 or": "", "call 12 +1 (523) 555-1055": "phone:8:25", "we saw 555 123 4567 or": ""}
    rows += [(1000 + i, t) for i, t in enumerate(new)]
    got = {r.doc_id: r[1] for r in pii.extract(spark.createDataFrame(rows, "doc_id long, text string"))
           .select("doc_id", spans.as_text(F.col("spans"))).collect()}
    assert [got[1000 + i] for i in range(len(new))] == list(new.values())


def contexts(spark, rows):
    found = pii.extract(spark.createDataFrame(rows, "doc_id long, text string"))
    return {r.doc_id: r[1] for r in found.select("doc_id", spans.as_text(F.col("spans"))).collect()}


def test_pii_word_before_any_white_space(spark):
    rows = [(i, f"reach me {w}tel: +1 (523) 555-10{i:02d} soon") for i in range(24) for w in (" ",)]
    new = ["the end.\ntel: 5235551099", "col\ttel: 5235551099", "x tel:\t5235551099", "x tel:\n5235551099",
           "x tel:" + " " * 90 + "5235551099", "tel: 5235551099", "line\r\ntel: 5235551099", "xtel: 5235551099",
           "y" * 70 + "tel: 5235551099", "\xa0tel: 5235551099"]
    got = contexts(spark, rows + [(100 + i, t) for i, t in enumerate(new)])
    at = [t.index("5235551099") for t in new]
    assert [got[100 + i] for i in range(len(new))] == [f"phone_context:{a}:{a + 10}" for a in at[:7]] + [""] * 3


def test_pii_words_longer_than_a_window_are_patterns_of_their_own(spark):
    a, b = "a" * 5_000 + "tel:", "b" * 5_000 + "tel:"
    rows = [(i, f"{a} +1 (523) 555-10{i:02d}") for i in range(20)] + [(90, f"{a} 5235551099"), (91, f"{b} 5235551099")]
    got = contexts(spark, rows)
    assert got[90] == f"phone_context:{len(a) + 1}:{len(a) + 11}" and got[91] == ""


@pytest.mark.parametrize("known, unseen, wrong, found", [(30, 10, 0, True), (10, 25, 0, True), (10, 40, 0, False),
                                                         (30, 10, 6, True), (30, 10, 12, False), (2, 1, 0, False)])
def test_pii_unseen_identifiers_do_not_contradict(spark, known, unseen, wrong, found):
    rows = [(i, f"tel: +1 (523) 555-{1000 + i}") for i in range(known)]
    rows += [(1000 + i, f"tel: 52355{20000 + i}") for i in range(unseen)] + [(5000 + i, f"tel: {i}th") for i in range(wrong)]
    got = contexts(spark, rows)
    assert {bool(got[1000 + i]) for i in range(unseen)} == {found}
    assert not any(got[5000 + i] for i in range(wrong))


def test_pii_follows_chains_to_their_end(spark):
    """Each word shares numbers with the next one only; the last four are reached in four steps."""
    rows, words = [], ["tel", "mobil", "cell", "fone", "handy"]
    for k, w in enumerate(words):
        numbers = [f"+1 (523) 555-{1000 + i}" for i in range(5)] if k == 0 else [f"523555{k}{100 + i}" for i in range(5)]
        rows += [(len(rows) + i, f"{w} {x}") for i, x in enumerate(numbers)]
        rows += [(len(rows) + i, f"{w} 523555{k + 1}{100 + i}") for i in range(5)]
    got = contexts(spark, rows)
    assert all("phone" in got[i] for i, _ in rows)


def test_licenses(docs, no_docs):
    got = license_scan.scan(docs).collect()
    want = []
    for d, t in texts(docs):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))
        at, labels = [], set()
        for phrase, label in license_scan.PHRASES.items():
            p = phrase.split()
            found = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            at += found
            labels |= {label} if found else set()
        want.append((d, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))))
    assert bag((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == bag(want)
    labels = {r.doc_id: (r.labels, r.score) for r in got}
    assert labels[15] == ("gpl-3", 1.0) and labels[14][0] == "apache-2,cc-by-nc,mit" and labels[5] == ("", 0.0)
    assert license_scan.scan(no_docs).count() == 0


def test_licenses_of_many_notices(spark):
    words = {label: (w, keys) for label, w, keys in license_scan.TEMPLATES}
    four = ". ".join(words[k][0] for k in ("gpl-3", "isc", "bsd", "mpl-2"))
    rows = [(0, four), (1, four + ". " + " ".join(sorted({w for _, t, _ in license_scan.TEMPLATES for w in t.split()})))]
    rows += [(i, words["gpl-3"][0] if i % 3 == 0 else f"plain text {i} to copy") for i in range(2, 60)]
    got = {r.doc_id: r.labels.split(",") for r in license_scan.scan(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all({"gpl-3", "isc", "bsd", "mpl-2"} <= set(got[i]) for i in (0, 1))
    assert all(("gpl-3" in labels) == (i % 3 == 0) for i, labels in got.items() if i > 1)


NOTICES = {
    "gpl-2": "GNU General Public License version 2",
    "gpl-3": "It is licensed under the GNU General Public License, either version 3 of the License, or later.",
    "bsd-3-clause": "Code: BSD 3-Clause License.",
    "mpl-2": "Mozilla Public License Version 2.0",
    "lgpl-2.1": "the GNU Lesser General Public License version 2.1 applies",
    "cc-by-sa": "Creative Commons Attribution-ShareAlike 4.0",
    "apache-2": "# SPDX-License-Identifier: Apache-2.0",
    "agpl-3": "// SPDX-License-Identifier: AGPL-3.0-only",
}


def test_licenses_of_headers_and_every_template(spark):
    """Usual headers get their label; every template, laid into text by hand, gets its own and is placed by the index."""
    rows = [(i, f"some text before. {t}\nand after") for i, t in enumerate(NOTICES.values())]
    rows += [(100 + i, f"words before {words} words after") for i, (_, words, _) in enumerate(license_scan.TEMPLATES)]
    # a key phrase with one word missing is no notice
    rows += [(200, "GNU General Public version 2"), (201, "Mozilla Public License"), (202, "SPDX-License: MIT"), (203, None)]
    got = {r.doc_id: set(r.labels.split(",")) for r in license_scan.scan(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(NOTICES))] == [{label} for label in NOTICES]
    assert all(label in got[100 + i] for i, (label, _, _) in enumerate(license_scan.TEMPLATES))
    assert all(got[i] == {""} for i in range(200, 204))


def test_leaks(spark, docs, no_docs):
    item = "What is the capital of the smallest country that the long river of the north crosses before it meets the sea?"
    edited = item.replace("smallest", "smalest").replace("north", "North").replace(" it ", " It, ")
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "too short"), (1, item),
                                   (5, "an item of forty bytes that is short too")], "item_id long, text string")
    rows = docs.select("doc_id", "text").union(spark.createDataFrame(
        [(500, item), (501, "noise " * 50 + item + " noise" * 50), (502, "É. " + edited), (503, item[:60]),
         (504, "see: an ITEM of forty bytes, that is short too")], "doc_id long, text string"))
    got = decontaminate.leaks(rows, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(500, 1), (501, 1), (502, 1), (504, 5)}
    by = {r.doc_id: r for r in got}
    assert by[501].distance == 0 and by[501].start == 300 and by[501].end == 300 + len(item) - 1
    assert by[502].distance == 1 and by[502].start == 3
    clean = decontaminate.clean(rows, items)
    assert clean.columns == rows.columns and clean.count() == rows.count() - 4
    assert decontaminate.leaks(no_docs, items).count() == 0 and decontaminate.leaks(docs, items.limit(0)).count() == 0


def test_leak_without_its_first_word_in_every_row():
    item = "What is the capital of the smallest country that the long river of the north crosses before it meets the sea?"
    m = decontaminate.Matcher(decontaminate.Index([(1, item)], 0.1))
    cut = item.split(" ", 1)[1]
    column = [cut, cut, "prose of another kind.", cut, None, "", cut + " and more"]
    got = {r: (d, a, b) for r, _, d, a, b in m.texts_of(pa.array(column, pa.string()))}
    assert set(got) == {0, 1, 3, 6} and len(set(got.values())) == 1


def test_short_items_leak_as_exact_copies():
    items = [(0, "Newton's laws?"), (1, "42"), (2, "長城はどこ"), (3, "été"), (4, ""), (5, "?!")]
    column = ["See «newton s LAWS», 42.", "newton s lawsuit 142 421 4.2", "質問は長城はどこにあるか", "un Été", "étés", None, "42"]
    m = decontaminate.Matcher(decontaminate.Index(items, 0.1))
    got = {(r, m.index.ids[i]): (d, column[r][a:b]) for r, i, d, a, b in m.texts_of(pa.array(column))}
    assert got == {(0, 0): (0, "newton s LAWS"), (0, 1): (0, "42"), (2, 2): (0, "長城はどこ"), (6, 1): (0, "42")}


def test_no_leak_is_lost_at_the_limit_of_edits():
    rng = random.Random(5)
    def some(n):
        return (" ".join(rng.choice(WORDS[:2] + WORDS[3:]) + rng.choice("aeiou") for _ in range(n // 4 + 2)))[:n - 1] + "z"
    items, changed = [], []
    for n in (20, 25, 30, 40, 50, 64, 70, 80, 95, 120, 150, 200, 300, 394):
        for r in range(8):
            text = some(n)
            most = int(0.1 * len(decontaminate.normal_form(np.frombuffer(text.encode(), np.uint8))[0]))
            at = rng.sample(range(n), most) if r % 2 else [int((j + .5) * n / most) for j in range(most)]
            out = "".join(rng.choice(["", "x", c + "y"]) if j in at else c for j, c in enumerate(text))
            items.append((len(items), text))
            changed.append(some(90) + ". " + out + ". " + some(90))
    text = "what is the capital of a land that lies by a sea and has a long river"
    items.append((len(items), text))
    changed.append(text[:12] + "x" + text[13:35] + "x" + text[36:])
    text = "世界上最长的河流是哪一条请写出它的名字和长度"
    items.append((len(items), text))
    changed.append("关于地理的问题" + text + "还有别的问题")
    m = decontaminate.Matcher(decontaminate.Index(items, 0.1))
    found = {(r, i) for r, i, *_ in m.texts_of(pa.array(changed))}
    forms = [decontaminate.normal_form(np.frombuffer(t.encode(), np.uint8))[0].tobytes() for t in changed]
    want = {(r, i) for r, t in enumerate(forms) for i, item in enumerate(m.texts)
            if decontaminate.nearest(item, t, int(0.1 * len(item)))}
    assert found == want and sum((i, i) in want for i in range(len(items))) > 100


@pytest.mark.parametrize("n", [30, 64, 80, 95, 120, 150, 200, 300])
def test_walks_alone_find_nine_in_ten(n):
    """Random edits of one byte in ten, found of those that verification of the whole text accepts."""
    rng = random.Random(n)
    vowels, others = "aeiou", "bcdfghklmnprst"
    word = lambda: "".join(rng.choice(others) + rng.choice(vowels) for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n // 2))[:n - 1] + "z"
    items = [(i, prose(n)) for i in range(150)]
    changed = []
    for _, t in items:
        at = set(rng.sample(range(n), int(0.1 * n)))
        changed.append(prose(60) + " " + "".join(
            rng.choice(["", rng.choice("qwxy"), c + "q"]) if j in at else c for j, c in enumerate(t)) + " " + prose(60))
    m = decontaminate.Matcher(decontaminate.Index(items, 0.1, exact=False))
    found = {(r, i) for r, i, *_ in m.texts_of(pa.array(changed))}
    near = [i for i, t in enumerate(m.texts) if decontaminate.nearest(t, decontaminate.normal_form(
        np.frombuffer(changed[i].encode(), np.uint8))[0].tobytes(), int(0.1 * len(t)))]
    assert len(near) > 75 and sum((i, i) in found for i in near) >= 0.9 * len(near)


def edit(a, b):
    """Least edit distance of a to a window of b."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [row[0] + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_nearest_is_exact_and_recall_holds():
    rng = random.Random(11)
    for _ in range(200):
        a = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 14)))
        b = bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 30)))
        hit = decontaminate.nearest(a, b, len(a))
        assert (hit[0] if hit else len(a)) == edit(a, b)
    items = [(i, " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(20))) for i in range(100)]
    changed = ["start " + "".join("" if (u := rng.random()) < .015 else rng.choice("xyz") if u < .03 else
                                  c + "q" if u < .045 else c for c in t) + " end" for _, t in items]
    m = decontaminate.Matcher(decontaminate.Index(items, 0.1))
    found = {(r, i) for r, i, *_ in m.texts_of(pa.array(changed))}
    near = [i for i, t in items if decontaminate.nearest(m.texts[i], decontaminate.normal_form(
        np.frombuffer(changed[i].encode(), np.uint8))[0].tobytes(), int(0.1 * len(m.texts[i])))]
    assert sum((i, i) in found for i in near) >= 0.95 * len(near) > 50


def brute_log_p(train, text, order):
    """Interpolated modified Kneser-Ney by its definition, from dictionaries."""
    from collections import Counter
    counts = {order: Counter(b for t in train for b in
                             (lambda x: [x[i:i + order] for i in range(len(x) - order + 1)])(b"\0" * (order - 1) + t))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cuts = {}
    for k, c in counts.items():
        n = [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.5
        cuts[k] = [min(i, max(0.05, i - (i + 1) * y * n[i] / n[i - 1])) if n[i - 1] else 0.5 * i for i in (1, 2, 3)]

    def p(g):
        if not g:
            return 1 / 256
        k = len(g)
        same = [v for h, v in counts[k].items() if h[:-1] == g[:-1]]
        if not same:
            return p(g[1:])
        free = sum(cuts[k][min(v, 3) - 1] for v in same)
        c = counts[k].get(g, 0)
        return (max(c - (cuts[k][min(c, 3) - 1] if c else 0), 0) + free * p(g[1:])) / sum(same)
    x = b"\0" * (order - 1) + text
    return sum(np.log(p(x[i:i + order])) for i in range(len(x) - order + 1))


@pytest.mark.parametrize("shard_rows", [10 ** 6, 40])
def test_kneser_ney_is_exact(spark, docs, shard_rows):
    train = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "été là"]
    df = spark.createDataFrame([(t,) for t in train], "text string")
    lookup = kneser_ney.lookup_of(kneser_ney.train(df, 3), shard_rows=shard_rows, order=3)
    assert (lookup.shards > 1) == (shard_rows < 1000)
    seen = ["the cat", "a log on the dog", "zebra", "", None, "là été", "t"]
    seen_df = spark.createDataFrame([(i, t) for i, t in enumerate(seen)], "i int, text string")
    got, again = (kneser_ney.score(seen_df, lookup, broadcast_rows=n).orderBy("i").collect() for n in (0, 10 ** 6))
    assert len(got) == len(again) == len(seen)
    assert all(abs(a["__log_prob"] - b["__log_prob"]) < 1e-4 for a, b in zip(got, again))
    for r, t in zip(got, seen):
        assert r["__n_bytes"] == len((t or "").encode())
        assert abs(r["__log_prob"] - brute_log_p([x.encode() for x in train], (t or "").encode(), 3)) < 1e-4


@pytest.mark.parametrize("shard_rows", [10 ** 6, 10])
def test_kneser_ney_fits_models_together(spark, shard_rows):
    texts = {0: ["the cat sat on the mat", "a cat and a dog"], 1: ["the dog sat on the log"], 4: ["zebra", "là été", "a"]}
    counts = [kneser_ney.ngrams(spark.createDataFrame([(t,) for t in ts], "text string"), 3).select(
        F.lit(m).alias("model"), "code", "n") for m, ts in texts.items()]
    models = kneser_ney.fit(stored(counts[0].union(counts[1]).union(counts[2]), "t-counts"), 3, "model")
    lookups = kneser_ney.lookups_of(models, [*texts, 7], None, shard_rows, 3)
    seen = ["the cat", "a log", "zebra", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(seen)], "i int, text string")
    for m, lookup in lookups.items():
        assert (lookup.shards > 1) == (shard_rows < 1000 and m in texts)
        for most in (0, 10 ** 6):
            for r in kneser_ney.score(df, lookup, broadcast_rows=most).collect():
                text = seen[r["i"]].encode()
                want = brute_log_p([t.encode() for t in texts[m]], text, 3) if m in texts else -len(text) * np.log(256)
                assert abs(r["__log_prob"] - want) < 1e-4


def test_classifier_takes_its_models_in_the_same_steps(spark, monkeypatch):
    """The driver keeps plans and threads for every table that is written, so four models must not write four times as many."""
    names = []
    write = kneser_ney.stored
    monkeypatch.setattr(kneser_ney, "stored", lambda df, name: names.append(name) or write(df, name))
    df = spark.createDataFrame([(i, f"the cat {i} sat on the mat", "en") for i in range(20)],
                               "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, int(i > 8)) for i in range(12)], "doc_id long, quality int, toxic int")
    assert kneser_ney.classify(df, labels).count() == 20
    assert names.count("kn-model") == names.count("kn-shards") == 1 and len(names) < 30


def test_classifier(spark, docs, no_docs):
    rng = random.Random(2)
    good = [(i, " ".join(rng.choice(WORDS) for _ in range(80)), "en") for i in range(120)]
    rows = [*good, (500, "@@## " * 60, "en"), (501, "", "en"), (502, None, None), (503, "!!! QX " * 40, "xx"),
            (504, good[0][1], None)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)] + [(7, 0, 0), (500, 0, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in kneser_ney.classify(df, labels).collect()}
    assert sum(kept[i] for i in range(120)) >= 117 and kept[504]
    assert not any(kept[i] for i in (500, 501, 502, 503))
    rest = kneser_ney.keep(df, labels)
    assert rest.columns == df.columns and {r.doc_id for r in rest.collect()} == {i for i, k in kept.items() if k}
    assert kneser_ney.classify(no_docs, labels).count() == 0
    untrained = kneser_ney.classify(df, labels.limit(0)).where("kept").count()
    assert untrained == len(rows) - 2


def test_marks_are_log_ratios(spark):
    clean = ["the cat sat on the mat", "the dog sat on the log"]
    toxic = ["the cat is an idiot", "idiot dog"]
    to_df = lambda ts: spark.createDataFrame([(t,) for t in ts], "text string")
    model, against = kneser_ney.train(to_df(clean), 3), kneser_ney.train(to_df(toxic), 3)
    for shard_rows in (10 ** 6, 40):
        lookup = kneser_ney.lookup_of(model, against, shard_rows, 3)
        tables = [kneser_ney.Table(pa.ipc.open_stream(r.body).read_all()) for r in lookup.rows.collect()]
        weights = {int(c): float(w) for t in tables for c, w in zip(*t.marks)}
        grams = {t[i:i + 3] for t in (b"\0\0" + x.encode() for x in toxic) for i in range(len(t) - 2)}
        for g in grams:
            # the log-ratio of the last byte, each by the texts' sums of one byte more and less
            ratio = (_last_log_p(toxic, g) - _last_log_p(clean, g))
            got = weights.get(int.from_bytes(g, "big"), 0.0)
            assert abs(got - max(0.0, ratio - kneser_ney.MARK)) < 1e-3
        text = "an idiot sat"
        seen = kneser_ney.score(spark.createDataFrame([(text,), (None,)], "text string"), lookup).collect()
        padded = b"\0\0" + text.encode()
        want = sum(weights.get(int.from_bytes(padded[i:i + 3], "big"), 0.0) for i in range(len(text)))
        assert want > 0 and sorted(round(r["__evidence"], 3) for r in seen) == [0.0, round(want, 3)]


def _last_log_p(texts, gram):
    known = [t.encode() for t in texts]
    start = gram.lstrip(b"\0")
    return brute_log_p(known, start, 3) - (brute_log_p(known, start[:-1], 3) if len(start) > 1 else 0.0) \
        if gram[0] == 0 else _inner(known, gram)


def _inner(known, gram):
    """log p of the last byte after two others, from a text that goes on to it and one that does not."""
    return brute_log_p(known, gram, 3) - brute_log_p(known, gram[:-1], 3)


def test_toxic_text_goes(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    good = [(i, text(150), "en") for i in range(200)]
    toxic = [(i, text(70) + " idiot scum " + text(70) + " worthless " + text(10), "en") for i in range(200, 240)]
    df = spark.createDataFrame(good + toxic, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, int(i >= 200)) for i in [*range(100), *range(200, 220)]],
                                   "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in kneser_ney.classify(df, labels).collect()}
    assert not any(kept[i] for i in range(200, 240)) and sum(kept[i] for i in range(200)) >= 197


def test_warc(spark, docs):
    pages = spark.createDataFrame(
        [(i, f"http://a/{i}", f"<p>{i}</p>") for i in range(20)] + [(30, "u", "<p>3</p>"), (31, "u", "<p>3</p>"),
         (40, None, None), (41, "x\r\ny", ""), (42, "v", "a\r\n\r\nWARC/1.1\r\nb"), (42, "v", "a\r\n\r\nWARC/1.1\r\nb"),
         (None, "q", "lone"), (None, "q", "<p>5</p>")], "page_id long, url string, html string")
    path = scratch_path(spark, "t-warc")
    warc.write(pages.withColumns({"sha": F.lit(1), "digest": F.lit(2)}), path)
    records = stored(warc.read(spark, path), "t-records")
    assert records.count() == 3 * pages.count()
    caps = warc.assemble(records).collect()
    assert len(caps) == pages.count() and all(len(c.requests) == len(c.metadata) == 1 for c in caps)
    kinds = {(dict((f.key, f.value) for f in c.metadata[0].fields).get("page-id"), c.response.warc_type) for c in caps}
    assert {("30", "revisit"), ("31", "revisit"), ("3", "response"), ("40", "response"), ("41", "revisit"),
            ("42", "response"), ("5", "response")} <= kinds
    stored_payloads = {bytes(c.response.payload) for c in caps if c.response.warc_type == "response"}
    assert stored_payloads == {(r.html or "").encode() for r in pages.collect()}
    for c in caps:
        if c.response.warc_type == "response":
            assert c.response.payload_digest == base64.b32encode(hashlib.sha1(c.response.payload).digest()).decode()
    none = scratch_path(spark, "t-warc")
    warc.write(pages.limit(0), none)
    assert warc.assemble(warc.read(spark, none)).count() == 0


def test_warc_links_over_hops(spark, docs):
    rows = [("r1", "response", []), ("q1", "request", ["r1"]), ("m1", "metadata", ["q1"]), ("n1", "metadata", ["m1"]),
            ("r2", "response", ["q2"]), ("q2", "request", []), ("lost", "metadata", ["nowhere"])]
    df = stored(spark.createDataFrame(rows, "record_id string, warc_type string, concurrent_to array<string>"), "t-hops")
    caps = {c.capture_id: c for c in warc.assemble(df).collect()}
    assert set(caps) == {"r1", "r2", "lost"} and caps["lost"].response is None
    assert [m.record_id for m in caps["r1"].metadata] == ["m1", "n1"] and caps["r2"].requests[0].record_id == "q2"
