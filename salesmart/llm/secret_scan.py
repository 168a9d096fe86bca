"""Incremental secret scan over a ledger of content-addressed versions.

Every version of every path is addressed by the SHA-256 of its text (a blob). The ledger is a
table with one row per scan of a blob: the rule versions that ran and the spans they found. A run
scans a blob only with the rule versions that the ledger does not hold for it, and only under one of
the ids that carry it, then appends to the ledger and joins the findings of the current rule
versions back to all paths. Giving a rule a new version makes just that rule run again.

Texts move once: rows that need no scan are listed (id and blob only) and the texts meet that list
in a shuffle join by id and blob, a key without hot values. Findings of a
blob that a third of the paths share are met by a join whose hot side the engine splits. All work
on texts is done by Spark SQL functions.

Defined results: a null text is the empty blob; repeated rows each get their blob's findings;
versions of one id are separate blobs; a null ``doc_id`` is a path like any other; an empty table
scans nothing; other columns are ignored. Spans count code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import spans as sp
from salesmart.llm.common import stored, text_of


@dataclass(frozen=True)
class Rule:
    """Java pattern and, where a match must pass one, the pattern that all of it has to match."""
    kind: str
    pattern: str
    passes: str | None = None
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# Forms of the secrets looked for, base kinds first.
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
BASE_RULES = (
    Rule("assign", _ASSIGN + "[A-Za-z0-9+/_.=-]+", _ASSIGN + "[A-Za-z0-9+/_.=-]{12,}"),
    # an access id and a run of hex digits end where their characters end, so a match that is too
    # short hides no longer one and the length can be asked for at once
    Rule("access", "AKIA[A-Z0-9]{14,}"),
    Rule("hex", "[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("private_key", "-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES
#: Texts without any of these strings hold no match of the rule, which is cheaper to see.
MARKS = {"access": "AKIA", "private_key": "PRIVATE KEY-----", "github": "gh", "slack": "xox", "jwt": "eyJ"}
LEDGER = f"blob binary, rules array<string>, findings {sp.SPAN.replace(',value:string', '')}"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger; empty where nothing was written yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan_texts(df: DataFrame, text: str, rules=RULES, todo: str | None = None) -> DataFrame:
    """Add ``findings``: the spans of all rules, or of those whose names the column ``todo`` lists."""
    when = {}
    for r in rules:
        asked = [F.array_contains(todo, r.name)] if todo else []
        asked += [F.contains(F.col(text), F.lit(MARKS[r.kind]))] if r.kind in MARKS else []
        if asked:
            when[r.kind] = asked[0] if len(asked) == 1 else asked[0] & asked[1]
    found = sp.find(df, text, {r.kind: r.pattern for r in rules}, "__found", when)
    passing = {r.kind: r.passes for r in rules if r.passes}

    def ok(s: Column) -> Column:
        test = F.lit(True)
        for kind, pattern in passing.items():
            test = test & ((s["kind"] != kind) | s["value"].rlike(f"^(?:{pattern})$"))
        return test

    kept = F.transform(F.filter("__found", ok), lambda s: F.struct(
        s["rank"].alias("rank"), s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.select("*", kept.alias("findings")).drop("__found")


def update(docs: DataFrame, ledger_path: str, id_col: str = "doc_id", text_col: str = "text",
           rules=RULES) -> DataFrame:
    """Bring the ledger up to date with ``docs``; returns the paths (doc_id, blob), a row each."""
    spark = docs.sparkSession
    names = [r.name for r in rules]
    rows = text_of(docs, id_col, text_col).withColumn("blob", F.unhex(F.sha2("text", 256)))
    paths = stored(rows.select("doc_id", "blob"), "secret-paths")
    all_rules, none = F.array(*map(F.lit, names)), F.array().cast("array<string>")
    seen = (read_ledger(spark, ledger_path).groupBy("blob")
            .agg(F.array_intersect(all_rules, F.flatten(F.collect_set("rules"))).alias("seen")))
    blobs = (paths.groupBy("blob").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
             .join(seen, "blob", "left").where("n > 1 or seen is not null"))
    # rows to leave out, wholly or for some rules: later copies, and what the ledger has
    done = stored(paths.join(blobs, "blob").select(
        F.col("doc_id").alias("k"), F.col("blob").alias("b"),
        F.when(F.col("doc_id").eqNullSafe(F.col("first")), F.coalesce("seen", none)).otherwise(all_rules).alias("skip"))
        .where("size(skip) > 0").distinct(), "secret-done")
    # the same plan at every size: texts meet the list by a shuffle, which holds the list's side in memory
    # by partition and sorts no text
    todo = (rows.join(done.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("blob") == F.col("b")), "left")
            .withColumn("todo", F.array_except(all_rules, F.coalesce("skip", none)))
            .where("size(todo) > 0").select("blob", "text", "todo"))
    (scan_texts(todo, "text", rules, "todo").select("blob", F.col("todo").alias("rules"), "findings")
     .write.mode("append").parquet(ledger_path))
    return paths


def scan(docs: DataFrame, ledger_path: str, id_col: str = "doc_id", text_col: str = "text",
         rules=RULES) -> DataFrame:
    """Bring the ledger up to date with ``docs`` and return a row per path: doc_id, blob, findings
    (as in ``LEDGER``; empty where there are none)."""
    paths = update(docs, ledger_path, id_col, text_col, rules)
    none = F.array().cast(LEDGER.split("findings ")[1])
    return (paths.join(current_findings(docs.sparkSession, ledger_path, rules), "blob", "left")
            .select("doc_id", "blob", F.coalesce("findings", none).alias("findings")))


def current_findings(spark: SparkSession, ledger_path: str, rules=RULES) -> DataFrame:
    """blob and findings of the given rule versions, for blobs that have some. Ranks are those of
    ``rules``, whatever list an earlier run used."""
    rank = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))))
    versions = F.create_map(*(x for r in rules for x in (F.lit(r.kind), F.lit(r.name))))
    mine = F.filter("findings", lambda s: F.array_contains("rules", versions[s["kind"]]))
    hits = (read_ledger(spark, ledger_path).withColumn("f", F.transform(mine, lambda s: F.struct(
        rank[s["kind"]].alias("rank"), s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
        .where("size(f) > 0"))
    return stored(hits.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("f"))).alias("findings")),
                  "secret-findings")


def redact(docs: DataFrame, ledger_path: str, text_col: str = "text", mark: str = "[SECRET]",
           rules=RULES, length_col: str | None = None) -> DataFrame:
    """``docs`` with every found secret replaced; all rows and columns stay. ``length_col``, if named,
    gets the new length of a changed text."""
    found = current_findings(docs.sparkSession, ledger_path, rules).select(
        F.col("blob").alias("__blob"), F.col("findings").alias("__findings"))
    blob = F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256))
    text = F.when(F.col("__findings").isNull(), F.col(text_col)).otherwise(
        sp.replaced(F.col(text_col), sp.ordered(F.col("__findings")), mark))
    length = F.when(F.col("__findings").isNull(), F.col(length_col)).otherwise(
        F.length("__clean").cast(docs.schema[length_col].dataType)) if length_col else None
    joined = (docs.withColumn("__key", blob).join(found, F.col("__key") == F.col("__blob"), "left")
              .withColumn("__clean", text))
    return joined.select(*(F.col("__clean").alias(c) if c == text_col else length.alias(c) if c == length_col
                           else F.col(c) for c in docs.columns))
