"""String functions with Python string semantics, built from native Spark expressions.

All of them are null-in, null-out and stay inside whole-stage codegen (regex and
higher-order functions only; no Python UDF).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.split()/str.strip() treat as whitespace.
PY_WS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def py_strip(c: Column) -> Column:
    """str.strip(): remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(c, rf"^{PY_WS}+|{PY_WS}+$", "")


def py_rstrip(c: Column) -> Column:
    """str.rstrip(): remove trailing whitespace of any kind."""
    return F.regexp_replace(c, rf"{PY_WS}+$", "")


def collapse_whitespace(c: Column) -> Column:
    """Replace each run of whitespace by one blank."""
    return F.regexp_replace(c, rf"{PY_WS}+", " ")


def py_words(c: Column) -> Column:
    """str.split(): whitespace-separated words, no empty ones."""
    return F.filter(F.split(c, rf"{PY_WS}+"), lambda w: w != F.lit(""))


def _cap_run(run: Column) -> Column:
    return F.concat(F.upper(F.substring(run, 1, 1)), F.lower(F.substring(run, 2, 1 << 30)))


def py_title(c: Column) -> Column:
    """str.title(): a letter after a non-letter is upper case, every other letter lower.

    Unlike ``initcap`` (which only looks at blanks) this gives O'Brien, St-Paul, 5Th.
    """
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, _cap_run), "")


def title_except_numbers(c: Column) -> Column:
    """Words split on whitespace; a word starting with a digit is lower-cased, any other is
    title-cased; words joined by one blank."""
    def fix(word: Column) -> Column:
        return F.when(word.rlike(r"^\d"), F.lower(word)).otherwise(py_title(word))
    return F.array_join(F.transform(py_words(c), fix), " ")


def strip_chars(c: Column, chars: str = ",.") -> Column:
    """Remove every occurrence of the given characters."""
    escaped = "".join("\\" + ch if ch in r"\^]-[" else ch for ch in chars)
    return F.regexp_replace(c, f"[{escaped}]", "")


def replace_literals(c: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Apply literal replacements in order, like chained str.replace calls."""
    out = c
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def fix_directions(c: Column, directions: Sequence[tuple[str, str]]) -> Column:
    """Pad one blank on the right, replace the padded direction words, strip the right end.

    A direction at the very start has no blank before it and stays as it is.
    """
    return py_rstrip(replace_literals(F.concat(c, F.lit(" ")), directions))


def clean_address(c: Column, directions: Sequence[tuple[str, str]]) -> Column:
    """title_except_numbers, then drop ',' and '.', then upper-case direction words."""
    return fix_directions(strip_chars(title_except_numbers(c), ",."), directions)


def rewrite_ci(c: Column, rewrites: Sequence[tuple[str, str]]) -> Column:
    """Case-insensitive regex rewrites, every occurrence, applied in order."""
    out = c
    for pattern, replacement in rewrites:
        out = F.regexp_replace(out, "(?i)" + pattern, replacement.replace("\\", "\\\\")
                               .replace("$", "\\$"))
    return out


def normalize_store_name(c: Column, rewrites: Sequence[tuple[str, str]]) -> Column:
    """Brand rewrites, keep text before the first '/' or '-', drop digits '#' '(' ')',
    strip the ends and collapse inner whitespace."""
    head = F.split(rewrite_ci(c, rewrites), "/|-", 2).getItem(0)
    return collapse_whitespace(py_strip(F.regexp_replace(head, r"[0-9#()]+", "")))
