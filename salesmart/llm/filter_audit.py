"""Filter interaction audit: what each filter removes in every order of application.

A document fails some of five filters. Its *survival word* has one bit for each of the 32 subsets
of the filters, set if the document passes every filter of the subset. The sum of the words' bits
by place, over the documents of a part and label, is the number of survivors of each subset, and
every figure of every order follows from those 32 numbers: what is kept after a step is the number
of survivors of the filters up to it.

The words are summed with carry-save adders: three words of one weight become one word of that
weight (their bitwise sum) and one of twice the weight (their carries), until one word of each
weight is left. A task keeps one such counter for each part and label, whatever the number of rows.

Only the failures and a digest of each text are written and shuffled, never texts. Equal rows meet
before any join. The filter on copies looks a row up by digest *and* id in the least ids of the
digests, so that a large group of copies is spread over all tasks.

Defined results: a null or empty text has no words and fails the word count; a null part is the
empty string; a row without id carries no label and is no copy of another, nor another of it; rows
of the same id and text are no copies of each other; a label holds if any row of the id has it; an
empty table gives no rows; very long texts are judged whole; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import stored

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
COPIES = FILTERS.index("E")
SPACE = r"[\x20\x09-\x0D]+"
#: Counters that a task holds before it hands their sums on.
HELD_GROUPS = 10_000

FIGURES = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
           "unique_fails long, good_lost long, toxic_lost long, shapley long")
POPULATIONS = ("all", "good", "toxic")


def failures(text: Column) -> Column:
    """Bits 0 to 3: the filters A to D that the text fails (a null text counts as empty)."""
    text = F.coalesce(text.cast("string"), F.lit(""))

    def judged(words: Column) -> Column:
        capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
        fails = (F.size(words) < 200, F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
                 capitals.cast("long") * 100 > F.length(text).cast("long") * 3, text.rlike("[#$%&*|]"))
        return sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0))

    # one lambda variable, so that the text is split once
    return F.get(F.transform(F.array(F.array_remove(F.split(text, SPACE), "")), judged), F.lit(0))


def survival_word(failed: int) -> int:
    """Bit s is set if a document that fails the filters ``failed`` passes all of subset s."""
    return sum(1 << s for s in range(SUBSETS) if not s & failed)


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           part_col: str = "lang") -> DataFrame:
    """part, good, toxic, failed (bits 0 to 4) and copies (rows that share all this and the text)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), failures(text).alias("failed"))
    rows = stored(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies")), "audit-rows")
    marks = stored(labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
                   .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")), "audit-labels")
    keyed, bare = rows.where("doc_id is not null"), rows.where("doc_id is null")
    firsts = stored(keyed.groupBy("digest").agg(F.min("doc_id").alias("doc_id")), "audit-firsts")
    keyed = (keyed.join(marks, "doc_id", "left")
             .join(firsts.withColumn("first", F.lit(True)), ["digest", "doc_id"], "left"))
    columns = ["part", "good", "toxic", "failed", "copies"]
    no = F.lit(False)
    keyed = keyed.select("part", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"),
                         F.when(F.col("first"), F.col("failed")).otherwise(F.col("failed") + (1 << COPIES))
                         .alias("failed"), "copies")
    return keyed.union(bare.withColumn("good", no).withColumn("toxic", no).select(*columns))


class Counter:
    """Carry-save positional popcount: ``levels[k]`` holds the words of weight 2**k."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def add(self, words: np.ndarray, copies: np.ndarray) -> None:
        """Count each word ``copies`` times."""
        for k in range(int(copies.max(initial=0)).bit_length()):
            self._put(k, words[copies >> k & 1 == 1])
        k = 0
        while k < len(self.levels):
            self._compress(k)
            k += 1

    def _put(self, k: int, words: np.ndarray) -> None:
        while len(self.levels) <= k:
            self.levels.append(np.zeros(0, np.uint32))
        self.levels[k] = np.concatenate([self.levels[k], words])

    def _compress(self, k: int) -> None:
        """Leave one word of weight 2**k at most; carries go up."""
        words, carries = self.levels[k], []
        while len(words) >= 3:
            n = len(words) // 3
            a, b, c = words[:n], words[n:2 * n], words[2 * n:3 * n]
            either = a ^ b
            carries.append((a & b) | (either & c))
            words = np.concatenate([either ^ c, words[3 * n:]])
        if len(words) == 2:
            carries.append(words[:1] & words[1:])
            words = words[:1] ^ words[1:]
        self.levels[k] = words
        if carries:
            self._put(k + 1, np.concatenate(carries))

    def counts(self) -> list[int]:
        """How many of the counted words have bit 0, 1, ... 31 set."""
        left = [(int(w), k) for k, level in enumerate(self.levels) for w in level]
        return [sum((w >> s & 1) << k for w, k in left) for s in range(SUBSETS)]


def survivors(rows: DataFrame) -> DataFrame:
    """part, population (index in ``POPULATIONS``), subset, n: rows of ``judged`` that pass the subset."""
    words = F.array(*(F.lit(np.array(survival_word(m), np.uint32).view(np.int32).item()) for m in range(SUBSETS)))
    rows = rows.select("part", (F.col("good").cast("int") + 2 * F.col("toxic").cast("int")).alias("label"),
                       F.get(words, F.col("failed")).alias("word"), "copies")

    def sums(held: dict) -> pa.RecordBatch:
        found = [(part, p, s, n) for (part, label), counter in held.items()
                 for p in range(3) if not p or label & p for s, n in enumerate(counter.counts())]
        columns = list(zip(*found)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            columns, (pa.string(), pa.int32(), pa.int32(), pa.int64()))], names=["part", "population", "subset", "n"])

    def run(batches):
        held: dict[tuple[str, int], Counter] = {}
        for b in batches:
            parts = b.column("part").dictionary_encode()
            names = parts.dictionary.to_pylist()
            group = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 4 + b.column("label").to_numpy()
            order = np.argsort(group, kind="stable")
            word = b.column("word").to_numpy().view(np.uint32)[order]
            copies = b.column("copies").to_numpy()[order]
            values, first = np.unique(group[order], return_index=True)
            for g, lo, hi in zip(values.tolist(), first.tolist(), [*first[1:].tolist(), len(word)]):
                held.setdefault((names[g // 4], g % 4), Counter()).add(word[lo:hi], copies[lo:hi])
            if len(held) > HELD_GROUPS:
                yield sums(held)
                held = {}
        yield sums(held)

    return (rows.mapInArrow(run, "part string, population int, subset int, n long")
            .groupBy("part", "population", "subset").agg(F.sum("n").alias("n")))


def figures(passed: np.ndarray):
    """(order, step, figures from ``kept`` on) of every order and step, from the survivors of each
    subset by population."""
    found, total = [], [0] * len(FILTERS)
    everyone = SUBSETS - 1
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            removed, good, toxic = (passed[:, before] - passed[:, after]).tolist()
            total[f] += removed
            failing = passed[0, 0] - passed[0, 1 << f]
            alone = passed[0, everyone ^ 1 << f] - passed[0, everyone]
            found.append((order, step, f, int(passed[0, after]), removed, int(failing) - removed, int(alone), good, toxic))
            before = after
    for order, step, f, *rest in found:
        yield ("".join(FILTERS[i] for i in order), step, *rest, total[f])


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "lang") -> DataFrame:
    """``FIGURES`` for every part, order and step; ``labels`` has doc_id, quality and toxic."""
    counted = survivors(judged(docs, labels, id_col, text_col, part_col))
    # at most 96 numbers of a part meet
    by_part = counted.groupBy("part").agg(F.collect_list(F.struct("population", "subset", "n")).alias("cells"))
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    fields = [c.split() for c in FIGURES.split(", ")]

    def run(batches):
        for b in batches:
            for part, cells in zip(b.column("part").to_pylist(), b.column("cells").to_pylist()):
                passed = np.zeros((len(POPULATIONS), SUBSETS), np.int64)
                for c in cells:
                    passed[c["population"], c["subset"]] = c["n"]
                rows = [(part, *r) for r in figures(passed)]
                yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)],
                                                 names=[n for n, _ in fields])

    return by_part.mapInArrow(run, FIGURES)
