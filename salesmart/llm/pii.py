"""Personal data by bootstrapped contextual extraction.

Seeds are the identifiers whose form alone tells them (addresses, numbers). Around every token
that holds a digit or an @ sign the word before it is its lexical pattern. Adjacent tokens of one line
that are digit groups outside seeds (``555 123 4567``, ``(523) 555-1099``) are one, with the word before
the first. Patterns and instances (the token texts) form a graph with an edge for every pair that occurs. Each round scores a
pattern by the occurrences whose instance is believed against those that contradict it (an instance
believed to be of another kind only, or like no identifier of the kind; one that is merely unseen
does not count against it), weighs in how many different instances it has met, and believes the
instances that well-scored patterns hold. Rounds go on until no instance is new. Patterns that end
with a high score mark the remaining identifier-like tokens that follow them, which no form
recognises, as spans of kind ``<kind>_context``. What is identifier-like depends on the kind: an @ sign
between two parts for email, ``MIN_DIGITS`` digits for the others, colon-separated groups also for ip.

All work on texts is done by Spark SQL functions in the row; the graph is aggregated per pair
before anything is joined, so a pattern as common as "the" is one pre-aggregated group, and only
accepted patterns, by their nature rare, are joined back.

Defined results: a null or empty text has no spans; repeated rows each get theirs (a repeated
instance counts as one for a pattern's support); a null ``doc_id`` stays null; ties do not arise
(scores are sums); an empty table gives no rows; very long texts and words are read whole; other
columns are ignored. Spans count code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm import spans as sp
from salesmart.llm.common import stored, text_of

KINDS = ("email", "ip", "card", "phone")
# Forms of the seed identifiers. Possessive repeats and the look-behinds keep the
# matches of the plain forms and make a long run of one class cost one pass.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # with the line break after it
    "token": r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+[\x0A-\x0D]?+",
}
# Digit groups that another may follow, and that may follow another.
_GROUP = r"[0-9]++(?:[()./-]++[0-9]++)*+"
OPENS, FOLLOWS = rf"\A[^\p{{L}}0-9@]*+{_GROUP}\)?\z", rf"\A[(+\[]*+{_GROUP}[^\p{{L}}0-9@]*+\z"
# Outer punctuation; a bracketed first group keeps its bracket.
LEAD, TRAIL = r"^(?:(?!\([0-9]+\)[^A-Za-z0-9]*[0-9])[^A-Za-z0-9+#])+", r"[^A-Za-z0-9]+$"
#: A pattern is accepted at this share of believed occurrences among believed and contradicting ones,
#: met with so many believed instances, if at least this share of all its occurrences is believed.
MIN_SCORE, MIN_SUPPORT, MIN_KNOWN = 0.8, 3, 0.25
#: A token or run of digit groups is like a number from so many digits.
MIN_DIGITS = 6
_SPACES = r"[\x20\x09-\x0D]+"
#: Characters before a token in which its word is looked for first; a longer word is taken from more.
WINDOWS = (64, 4096)
FOUND = "array<struct<rank:int,kind:string,start:int,end:int>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.aggregate(
        F.array(c.cast("int") * (1 + i % 2)), F.lit(0),
        lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(s: Column) -> Column:
    n = F.length(_digits(s["value"]))
    small = F.forall(F.split(s["value"], r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3)
                     & (F.regexp_replace(p, "^0+(?=.)", "").try_cast("long") <= 255))
    return (F.when(s["kind"] == "email", F.lit(True))
            .when(s["kind"] == "ip", small)
            .when(s["kind"] == "card", F.when(n.between(14, 19), luhn(_digits(s["value"]))).otherwise(False))
            .when(s["kind"] == "phone", n.between(10, 15)).otherwise(False))


def _like(kind: Column, instance: Column) -> Column:
    """Whether an instance is like an identifier of the kind."""
    number = F.length(_digits(instance)) >= MIN_DIGITS
    return (F.when(kind == "email", instance.rlike(r"\A[^@]+@[^@]+\z"))
            .when(kind == "ip", number | instance.rlike(r"\A[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,}\z"))
            .otherwise(number))


def _like_any() -> Column:
    """Whether ``instance`` is like an identifier of some kind."""
    return F.greatest(*(_like(F.lit(k), F.col("instance")) for k in KINDS))


def _word_before(text: Column, start: Column) -> Column:
    """The last word of the text's first ``start`` characters, lower-cased; none: empty. Only a word that
    a window does not hold whole is looked for in a wider one, at last in all that stands before."""
    def last(size: Column) -> tuple[Column, Column]:
        ahead = F.regexp_replace(F.substring(text, start - size + 1, size), _SPACES + r"\z", "")
        word = F.element_at(F.split(ahead, _SPACES), -1)
        return word, (size == start) | ((F.length(word) < F.length(ahead)) & (word != ""))

    word, _ = last(start)
    for size in reversed(WINDOWS):
        near, whole = last(F.least(start, F.lit(size)))
        word = F.when(whole, near).otherwise(word)
    return F.lower(word)


def _bare(c: Column) -> Column:
    return F.struct(c["rank"].alias("rank"), c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))


def seeds(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_no, doc_id, base (valid seed spans) and occurrences (the tokens with a digit or @, or runs of
    digit groups: place, text without outer punctuation or that of the seed which begins in it, word
    before, that seed)."""
    rows = text_of(docs, id_col, text_col).withColumn("row_no", F.monotonically_increasing_id())
    digit = F.col("text").rlike("[0-9]")
    rows = sp.held(rows, has_digit=digit, has_at=F.contains(F.col("text"), F.lit("@")))
    df = sp.find(rows, "text", PATTERNS, "found", {
        "email": F.col("has_at"), "ip": F.col("has_digit"), "card": F.col("has_digit"),
        "phone": F.col("has_digit") & F.contains(F.col("text"), F.lit("+")),
        "token": F.col("has_digit") | F.col("has_at")})
    df = sp.held(df, base=F.transform(F.filter("found", lambda s: (s["kind"] != "token") & _valid(s)), _bare))
    tokens = F.filter("found", lambda s: s["kind"] == "token")
    value = lambda r: F.regexp_replace(F.regexp_replace(r["raw"], LEAD, ""), TRAIL, "")
    lead = lambda r: F.length(F.regexp_extract(r["raw"], LEAD, 0))
    before = lambda s: _word_before(F.col("text"), s["start"])
    # the tokens that go on with a seed which began before them are part of it
    first = F.filter(tokens, lambda s: ~F.exists("base", lambda b: (b["start"] < s["start"]) & (b["end"] > s["start"])))
    inside = lambda s: F.filter("base", lambda b: (b["start"] < s["end"]) & (b["start"] >= s["start"]))
    df = sp.held(df, tokens=F.transform(first, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), inside(s).alias("seeds"))))
    df = sp.held(df, opens=F.transform("tokens", lambda t: (F.size(t["seeds"]) == 0) & t["value"].rlike(OPENS)),
                 follows=F.transform("tokens", lambda t: (F.size(t["seeds"]) == 0) & t["value"].rlike(FOLLOWS)))
    goes_on = lambda t, i: (F.get("follows", i) & F.coalesce(F.get("opens", i - 1), F.lit(False))
                            & (F.get("tokens", i - 1)["end"] + 1 == t["start"]))
    df = sp.held(df, firsts=F.transform(F.filter(F.transform("tokens", lambda t, i: F.struct(
        i.alias("i"), F.coalesce(goes_on(t, i), F.lit(False)).alias("goes_on"))), lambda t: ~t["goes_on"]),
        lambda t: t["i"]))
    # the tokens of a run stand one blank apart
    df = sp.held(df, runs=F.transform("firsts", lambda i, k: F.struct(
        F.get("tokens", i)["start"].alias("start"), F.get("tokens", i)["seeds"].alias("seeds"),
        F.array_join(F.transform(F.slice("tokens", i + 1, F.coalesce(F.get("firsts", k + 1), F.size("tokens")) - i),
                                 lambda t: t["value"]), " ").alias("raw"))))
    seed_text = lambda r: F.get(F.transform(r["seeds"], lambda b: F.substring(
        F.col("text"), b["start"] + 1, b["end"] - b["start"])), F.lit(0))
    occurrences = F.transform("runs", lambda r: F.struct(
        (r["start"] + lead(r)).alias("start"), (r["start"] + lead(r) + F.length(value(r))).alias("end"),
        F.coalesce(seed_text(r), value(r)).alias("instance"), before(r).alias("pattern"), r["seeds"].alias("seeds")))
    return df.select("row_no", "doc_id", "base", occurrences.alias("occurrences"))


def bootstrap(seeded: DataFrame, min_score: float = MIN_SCORE, min_support: int = MIN_SUPPORT,
              min_known: float = MIN_KNOWN) -> DataFrame:
    """pattern, kind, score of the accepted patterns. ``seeded`` is a stored ``seeds`` table."""
    occurrences = seeded.select(F.explode("occurrences").alias("o")).select("o.*").where("pattern <> ''")
    kinds = F.array(*(F.when(_like(F.lit(k), F.col("instance")), F.lit(k)) for k in KINDS))
    pairs = stored(occurrences.groupBy("pattern", "instance").agg(
        F.count("*").alias("n"), F.any_value(F.get("seeds", F.lit(0))["kind"], ignoreNulls=True).alias("seed"))
        .withColumn("like", F.array_compact(kinds)), "pii-pairs")
    believed = stored(pairs.where("seed is not null").select("instance", F.col("seed").alias("kind")).distinct(),
                      "pii-instances")
    total = stored(pairs.groupBy("pattern").agg(F.sum("n").alias("total")), "pii-totals")
    known, before = believed.count(), -1
    accepted = None
    while accepted is None or known > before:
        votes = (pairs.join(believed, "instance").groupBy("pattern", "kind")
                 .agg(F.sum("n").alias("good"), F.count_distinct("instance").alias("support")))
        unseen = (pairs.where(F.size("like") > 0).join(believed.select("instance").distinct(), "instance", "left_anti")
                  .select("pattern", F.explode("like").alias("kind"), "n")
                  .groupBy("pattern", "kind").agg(F.sum("n").alias("unseen")))
        accepted = stored(votes.join(total, "pattern").join(unseen, ["pattern", "kind"], "left")
                          .withColumn("score", F.col("good") / (F.col("total") - F.coalesce("unseen", F.lit(0))))
                          .where((F.col("score") >= min_score) & (F.col("support") >= min_support)
                                 & (F.col("good") >= F.col("total") * min_known))
                          .select("pattern", "kind", "score"), "pii-patterns")
        found = (pairs.where(F.size("like") > 0).join(accepted, "pattern")
                 .where(F.array_contains("like", F.col("kind"))).select("instance", "kind"))
        believed = stored(believed.union(found).distinct(), "pii-instances")
        before, known = known, believed.count()
    return accepted


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and spans (ordered; the seeds, then those that accepted patterns add) per row."""
    seeded = stored(seeds(docs, id_col, text_col), "pii-seeds")
    accepted = bootstrap(seeded)
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    more = (seeded.select("row_no", F.explode("occurrences").alias("o")).select("row_no", "o.*")
            .where((F.size("seeds") == 0) & _like_any())
            .join(accepted, "pattern").where(_like(F.col("kind"), F.col("instance")))
            .select("row_no", F.struct((place + len(KINDS)).cast("int").alias("rank"),
                                       F.concat("kind", F.lit("_context")).alias("kind"), "start", "end").alias("s"))
            .groupBy("row_no").agg(F.collect_set("s").alias("more")))
    joined = seeded.join(more, "row_no", "left")
    none = F.array().cast(FOUND)
    return joined.select("doc_id", sp.ordered("base").alias("base"),
                         sp.ordered(F.concat("base", F.coalesce("more", none))).alias("spans"))
