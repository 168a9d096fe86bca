"""License notices by a positional index of rare template words.

The index lists, for every word of the notice templates, where it stands in which template. How
rare a license word is, is counted over all documents (a table no longer than the vocabulary of
the templates). Of every mandatory key phrase the ``ANCHORS`` words of highest IDF are looked up in
every document that holds all words of some phrase; every posting says where the template would have
to begin, and places on which all anchors of a phrase agree are candidates. A template counts only
where one of its key phrases stands whole, anchors included, so no place is lost, and no notice
competes with another, however many a text holds or how common one is. There the whole template is
laid over the document: it counts if every word of one of its key phrases stands in its place, and
its score is the share of the template's IDF weight that matches.

All work is done by Spark SQL functions: words, license words and their positions in the row;
candidates, a handful for each notice, as rows. A notice in a third of the documents costs its own
rows and nothing more. Postings and templates are joined as broadcast tables of fixed size.

Defined results: a null or empty text has no words, no places, empty labels and score 0; repeated
rows are judged each by itself; equal IDF goes by the word; a null ``doc_id`` stays null; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm import spans as sp
from salesmart.llm.common import stored, text_of

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases that give a label wherever their words stand consecutively.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Notice templates: label, words, mandatory key phrases.
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files", ("permission is hereby granted", "free of charge")),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nc", "creative commons attribution noncommercial", ("attribution noncommercial",)),
    ("gpl-3", "this work is licensed under the gnu general public license version 3",
     ("gnu general public license version 3",)),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation",
     ("gnu general public license",)),
    ("lgpl", "under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     ("redistribution and use in source and binary forms",)),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee "
            "is hereby granted", ("for any purpose with or without fee",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("unencumbered software",)),
    # names of licenses as they stand in headers and lists, with "v" and "version"
    ("gpl-2", "gnu general public license version 2", ("gnu general public license version 2",)),
    ("gpl-2", "gnu general public license v2", ("gnu general public license v2",)),
    ("gpl-3", "gnu general public license v3", ("gnu general public license v3",)),
    ("gpl-3", "licensed under the gnu general public license either version 3 of the license",
     ("gnu general public license either version 3",)),
    ("gpl-2", "under the terms of the gnu general public license as published by the free software foundation "
              "either version 2 of the license or at your option any later version",
     ("gnu general public license as published by the free software foundation "
      "either version 2 of the license",)),
    ("gpl-3", "under the terms of the gnu general public license as published by the free software foundation "
              "either version 3 of the license or at your option any later version",
     ("gnu general public license as published by the free software foundation "
      "either version 3 of the license",)),
    ("agpl-3", "gnu affero general public license version 3", ("gnu affero general public license",)),
    ("lgpl-2.1", "gnu lesser general public license version 2 1", ("gnu lesser general public license version 2 1",)),
    ("lgpl-3", "gnu lesser general public license version 3", ("gnu lesser general public license version 3",)),
    ("bsd-2-clause", "bsd 2 clause license", ("bsd 2 clause",)),
    ("bsd-3-clause", "bsd 3 clause license", ("bsd 3 clause",)),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to "
                     "endorse or promote products derived from this software without specific prior written "
                     "permission", ("neither the name of", "endorse or promote products derived from this software")),
    ("mpl-2", "mozilla public license version 2 0", ("mozilla public license version 2 0",)),
    ("epl-2", "eclipse public license version 2 0", ("eclipse public license",)),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in "
                 "compliance with the license", ("you may not use this file except in compliance with the license",)),
    ("cc-by", "creative commons attribution 4 0", ("creative commons attribution 4 0",)),
    ("cc-by-sa", "creative commons attribution sharealike 4 0", ("attribution sharealike",)),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0", ("attribution noncommercial",)),
    ("cc-by-nd", "creative commons attribution noderivatives 4 0", ("attribution noderivatives",)),
    ("cc0", "cc0 1 0 universal", ("cc0 1 0 universal",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the "
             "authors be held liable for any damages arising from the use of this software",
     ("in no event will the authors be held liable",)),
    # machine-readable lines
    *((label, f"spdx license identifier {name}", (f"spdx license identifier {name}",)) for label, name in (
        ("mit", "mit"), ("apache-2", "apache 2 0"), ("bsd-2-clause", "bsd 2 clause"), ("bsd-3-clause", "bsd 3 clause"),
        ("gpl-2", "gpl 2 0"), ("gpl-3", "gpl 3 0"), ("lgpl-2.1", "lgpl 2 1"), ("lgpl-3", "lgpl 3 0"),
        ("agpl-3", "agpl 3 0"), ("mpl-2", "mpl 2 0"), ("epl-2", "epl 2 0"), ("isc", "isc"), ("unlicense", "unlicense"),
        ("cc0", "cc0 1 0"), ("zlib", "zlib"))),
)
#: Highest-IDF words of a key phrase that are looked up, and the least score of a label.
ANCHORS, MIN_SCORE = 2, 0.6


def _index() -> list[tuple]:
    """(template, place, word, key phrase or null) rows."""
    rows = []
    for t, (_, words, keys) in enumerate(TEMPLATES):
        words = words.split()
        for k, phrase in enumerate(keys):
            phrase = phrase.split()
            at = next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)
            rows += [(t, at + i, w, k) for i, w in enumerate(phrase)]
        rows += [(t, i, w, None) for i, w in enumerate(words)]
    return rows


def _anchors(weight: dict[str, float]) -> list[tuple]:
    """(template, key, word, place, number of anchors) rows: the postings by which a phrase is looked up."""
    rows = []
    for t, (_, _, keys) in enumerate(TEMPLATES):
        for k in range(len(keys)):
            places = [r for r in _index() if r[0] == t and r[3] == k]
            # a word that no document holds comes first: then the phrase stands nowhere
            rare = sorted({r[2] for r in places}, key=lambda w: (-weight.get(w, float("inf")), w))[:ANCHORS]
            rows += [(t, k, w, place, len(rare)) for _, place, w, _ in places if w in rare]
    return rows


def _phrase_possible() -> Column:
    """Whether the text has all words of some phrase that a label asks for."""
    asked = sorted({tuple(sorted(set(p.split()))) for _, _, keys in TEMPLATES for p in keys}
                   | {tuple(sorted(set(p.split()))) for p in PHRASES})
    possible = F.lit(False)
    for words in asked:
        every = F.lit(True)
        for w in words:
            every = every & F.array_contains("present", w)
        possible = possible | every
    return possible


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased. Spark's ``lower`` differs only by letters outside ASCII, of which one, the
    Kelvin sign, would become an ASCII letter."""
    upper = "".join(map(chr, range(65, 91)))
    return F.when(F.contains(text, F.lit("K")), F.translate(text, upper, upper.lower())).otherwise(F.lower(text))


def _phrase_places(phrase: str) -> Column:
    """Places of a phrase, from the license words of the row (all words of phrases are such)."""
    first, *rest = phrase.split()
    def stands(h):
        ok = h["word"] == first
        for i, w in enumerate(rest, 1):
            ok = ok & (F.get("words", h["pos"] + i) == w)
        return ok
    return F.transform(F.filter("hits", stands), lambda h: h["pos"])


def license_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_no, doc_id, n_words, present (license words of the text), places per base phrase, and
    hits (positions of license words) of texts that hold all words of some phrase: no other text can get
    a label."""
    index = _index()
    vocabulary = sorted({r[2] for r in index} | {w for p in PHRASES for w in p.split()})
    words = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(WORD), F.lit(0))
    rows = text_of(docs, id_col, text_col).withColumn("row_no", F.monotonically_increasing_id())
    df = sp.held(rows, words=words).drop("text")
    df = sp.held(df, present=F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary))))
    df = sp.held(df, hits=F.when(_phrase_possible(), F.filter(
        F.transform("words", lambda w, i: F.struct(i.alias("pos"), w.alias("word"))),
        lambda h: h["word"].isin(vocabulary))))
    none = F.array().cast("array<int>")
    return df.select("row_no", "doc_id", F.size("words").cast("long").alias("n_words"), "present", "hits",
                     *(F.coalesce(_phrase_places(p), none).alias(f"places_{i}") for i, p in enumerate(PHRASES)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    spark = docs.sparkSession
    rows = stored(license_words(docs, id_col, text_col), "license-words")
    index = _index()
    postings = spark.createDataFrame(index, "template int, place int, word string, key int")
    # at most one row for each word of the templates
    counts = rows.select(F.explode("present").alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    idf = stored(counts.crossJoin(F.broadcast(rows.agg(F.count("*").alias("all"))))
                 .select("word", F.log((F.col("all") + 1) / F.col("df")).alias("idf")), "license-idf")
    weight = {r[0]: r[1] for r in idf.collect()}
    words = postings.where("key is null").join(F.broadcast(idf), "word", "left").select(
        "template", "place", "word", F.coalesce("idf", F.lit(max(weight.values(), default=1.0))).alias("idf"))
    whole = words.groupBy("template").agg(F.sum("idf").alias("whole"))
    needed = (postings.where("key is not null").groupBy("template", "key")
              .agg(F.count("*").alias("need")))
    anchors = spark.createDataFrame(_anchors(weight), "template int, k int, word string, place int, votes_needed int")

    noticed = rows.where("hits is not null").select("row_no", "hits")
    looked_up = noticed.select("row_no", F.explode(F.filter(
        "hits", lambda h: h["word"].isin(sorted({r[2] for r in _anchors(weight)})))).alias("h")).select("row_no", "h.*")
    candidates = (looked_up.join(F.broadcast(anchors), "word")
                  .groupBy("row_no", "template", "k", "votes_needed", (F.col("pos") - F.col("place")).alias("begin"))
                  .agg(F.count_distinct("word").alias("votes")).where("votes >= votes_needed")
                  .select("row_no", "template", "begin").distinct())
    hits = noticed.select(F.col("row_no").alias("r"), F.explode("hits").alias("h")).select("r", "h.*")
    laid = (candidates.join(F.broadcast(postings.withColumnRenamed("template", "t")), F.col("template") == F.col("t"))
            .join(hits.withColumnRenamed("word", "w"), (F.col("row_no") == F.col("r")) & (F.col("w") == F.col("word"))
                  & (F.col("pos") == F.col("begin") + F.col("place"))))
    phrase = (laid.where("key is not null").groupBy("row_no", "template", "begin", "key")
              .agg(F.count("*").alias("met")).join(F.broadcast(needed), ["template", "key"]).where("met = need")
              .select("row_no", "template", "begin").distinct())
    score = (laid.where("key is null").join(F.broadcast(words.select(
        F.col("template").alias("t2"), F.col("place").alias("p2"), "idf")),
        (F.col("template") == F.col("t2")) & (F.col("place") == F.col("p2")))
        .groupBy("row_no", "template", "begin").agg(F.sum("idf").alias("got"))
        .join(F.broadcast(whole), "template")
        .select("row_no", "template", "begin", F.least(F.lit(1.0), F.col("got") / F.col("whole")).alias("score")))
    label = F.create_map(*(F.lit(x) for t, row in enumerate(TEMPLATES) for x in (t, row[0])))
    verified = (score.join(phrase, ["row_no", "template", "begin"]).where(F.col("score") >= MIN_SCORE)
                .groupBy("row_no").agg(F.collect_set(label[F.col("template")]).alias("more"),
                                       F.max("score").alias("score")))
    places = [F.col(f"places_{i}") for i in range(len(PHRASES))]
    every = F.concat(*places)
    base = F.array_sort(F.array_distinct(F.array_compact(F.array(*(
        F.when(F.size(p) > 0, F.lit(v)) for p, v in zip(places, PHRASES.values()))))))
    return rows.join(verified, "row_no", "left").select(
        "doc_id", "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("more", F.array().cast("array<string>")))), ",")
        .alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
