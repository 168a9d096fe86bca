"""Places of pattern matches in texts, by Spark's own functions.

``regexp_extract_all`` gives the matches of a text and ``split`` the gaps between them, both
leftmost and non-overlapping, so running sums of their lengths are the places, in code points.
The sums run in blocks, which keeps the work of a text with very many matches near linear.
Everything stays in the row: nothing is exploded or shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 256
#: A span: kind, first code point, code point after the last, the matched text.
SPAN = "array<struct<rank:int,kind:string,start:int,end:int,value:string>>"


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once for each row: later expressions, which may use them many
    times or inside a lambda, are not merged with their definition."""
    names = list(columns)
    return df.select("*", F.inline(F.array(F.struct(*(columns[n].alias(n) for n in names)))))


def _blocks(matches: Column, gaps: Column) -> Column:
    """Lengths of every gap and match, in blocks."""
    steps = F.transform(matches, lambda m, i: F.struct(F.length(F.get(gaps, i)).alias("gap"),
                                                       F.length(m).alias("len")))
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / BLOCK).cast("int")),
                       lambda b: F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)))


def _starts(items: Column, first: Column, gap, size) -> Column:
    """Where each item starts, when the first begins at ``first`` and each follows its gap."""
    return F.aggregate(
        items, F.struct(F.array().cast("array<int>").alias("out"), first.cast("int").alias("at")),
        lambda a, x: F.struct(F.concat(a["out"], F.array(a["at"] + gap(x))).alias("out"),
                              (a["at"] + gap(x) + size(x)).alias("at")),
        lambda a: a["out"])


def find(df: DataFrame, text: str, patterns: Mapping[str, str], out: str = "spans",
         when: Mapping[str, Column] | None = None) -> DataFrame:
    """Add ``out``: all matches of the patterns (kind to Java pattern), ordered by kind as listed,
    then place. ``when`` holds a condition on the row under which a kind is looked for."""
    when = when or {}
    kinds = list(patterns)
    none = F.array().cast("array<string>")

    def matches(k: str) -> Column:
        all_ = F.regexp_extract_all(F.col(text), F.lit(patterns[k]), F.lit(0))
        return F.when(when[k], all_).otherwise(none) if k in when else all_

    df = held(df, **{f"__m{i}": matches(k) for i, k in enumerate(kinds)})
    df = held(df, **{f"__g{i}": F.when(F.size(f"__m{i}") > 0, F.split(F.col(text), patterns[k], -1))
                     for i, k in enumerate(kinds)})
    df = held(df, **{f"__b{i}": F.when(F.size(f"__m{i}") > 0, _blocks(F.col(f"__m{i}"), F.col(f"__g{i}")))
                     for i in range(len(kinds))})
    df = held(df, **{f"__s{i}": F.when(F.size(f"__m{i}") > 0, _starts(
        F.transform(F.col(f"__b{i}"), lambda b: F.aggregate(
            b, F.lit(0), lambda a, x: a + x["gap"] + x["len"])), F.lit(0), lambda x: F.lit(0), lambda x: x))
        for i in range(len(kinds))})
    df = held(df, **{f"__o{i}": F.when(F.size(f"__m{i}") > 0, _all_starts(f"__b{i}", f"__s{i}"))
                     for i in range(len(kinds))})
    found = [F.coalesce(_spans(i, k), F.array().cast(SPAN)) for i, k in enumerate(kinds)]
    df = held(df, **{out: F.concat(*found)})
    return df.drop(*(f"__{c}{i}" for c in "mgbso" for i in range(len(kinds))))


def _all_starts(blocks: str, firsts: str) -> Column:
    return F.flatten(F.transform(blocks, lambda b, n: _starts(
        b, F.get(firsts, n), lambda x: x["gap"], lambda x: x["len"])))


def _spans(rank: int, kind: str) -> Column:
    start = F.col(f"__o{rank}")
    return F.transform(f"__m{rank}", lambda m, n: F.struct(
        F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), F.get(start, n).alias("start"),
        (F.get(start, n) + F.length(m)).alias("end"), m.alias("value")))


def ordered(spans: Column) -> Column:
    """By start, then kind as listed."""
    return F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of ordered spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def replaced(text: Column, spans: Column, mark: str) -> Column:
    """The text with every ordered span (overlapping ones together) replaced by ``mark``."""
    step = F.aggregate(
        spans, F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.struct(
            F.when(s["start"] >= a["at"], F.concat(a["out"], F.array(
                F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark)))).otherwise(a["out"]).alias("out"),
            F.greatest(a["at"], s["end"]).alias("at")),
        lambda a: F.concat(a["out"], F.array(F.substring(text, a["at"] + 1, F.length(text)))))
    return F.array_join(step, "")
