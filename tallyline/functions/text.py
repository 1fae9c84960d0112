"""Text functions with the exact semantics the ballot rules rely on."""

from __future__ import annotations

import re
from collections import Counter
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.nulls import col, is_in
from tallyline.shipping import by_value

by_value(__name__)


def pad_left(c: Column | str, width: int, fill: str = "0") -> Column:
    """Left pad that never shortens a value already wider than ``width``."""
    c = col(c)
    return F.lpad(c, F.greatest(F.length(c), F.lit(width)), fill)


def pad_int(c: Column | str, width: int, fill: str = "0") -> Column:
    """Text to integer to zero-padded text; not-a-number becomes null."""
    return pad_left(col(c).try_cast("int").cast("string"), width, fill)


def squish(c: Column | str) -> Column:
    """Trim, and fold every run of white space to one blank."""
    return F.trim(F.regexp_replace(col(c), r"\s+", " "))


def title_case(c: Column | str) -> Column:
    """Capital at every word start; an apostrophe does not start a word."""
    pieces = F.split(F.lower(col(c)), r"(?<=[^\p{L}\p{N}'’])")
    return F.array_join(
        F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), ""
    )


def detect(c: Column | str, pattern: str, ignore_case: bool = True) -> Column:
    return col(c).rlike(("(?i)" if ignore_case else "") + pattern)


def extract(c: Column | str, pattern: str) -> Column:
    """First match of the whole pattern, null (not an empty string) without one."""
    return F.regexp_substr(col(c), F.lit(pattern))


def replace_first(c: Column | str, pattern: str, replacement: str) -> Column:
    """Replace the first match only (``regexp_replace`` alone replaces all).

    The pattern is anchored behind the shortest prefix, so it can match once;
    the column occurs once, which keeps chains of replacements linear in size.
    ``replacement`` is literal text.
    """
    literal = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(col(c), rf"^([\s\S]*?)(?:{pattern})", f"$1{literal}")


def remove_all(c: Column | str, pattern: str, ignore_case: bool = False) -> Column:
    return F.regexp_replace(col(c), ("(?i)" if ignore_case else "") + pattern, "")


def drop_non_ascii(c: Column | str) -> Column:
    """Remove every character outside ASCII (and undecodable bytes)."""
    return F.regexp_replace(col(c), r"[^\x00-\x7F]", "")


def strip_bracket_suffix(c: Column | str) -> Column:
    """``Style 4 [2]`` -> ``Style 4``: the page marker some vendors append."""
    return F.regexp_replace(col(c), r" \[.*\]", "")


def has_field(c: Column | str, value: str) -> Column:
    """Is ``value`` one of the ``|``-separated fields (blanks around it ignored)?"""
    return F.array_contains(F.transform(F.split(col(c), r"\|"), lambda f: F.trim(f)), value)


def join_sorted(values: Column, separator: str = "|") -> Column:
    """Array -> distinct, sorted, joined text."""
    return F.array_join(F.array_sort(F.array_distinct(values)), separator)


def comma_number(c: Column | str, decimals: int = 0) -> Column:
    return F.format_number(col(c), decimals)


def percent_text(share: Column, decimals: int = 0) -> Column:
    """Share as percent text without the sign; a rounded ``0`` shows as ``<1``."""
    text = F.format_number(share * 100, decimals)
    return F.when(text == "0", F.lit("<1")).otherwise(text)


def null_tokens(c: Column | str, tokens: tuple[str, ...] = ("", "NA", "#N/A")) -> Column:
    """Null for the strings that spell a missing value in hand-made files."""
    return F.when(is_in(c, tokens), F.lit(None)).otherwise(col(c))


@F.pandas_udf(T.StringType())
def _nfd(values: pd.Series) -> pd.Series:
    return values.map(lambda v: unicodedata.normalize("NFD", v), na_action="ignore")


def decompose(c: Column | str) -> Column:
    """Canonical decomposition (NFD).

    The JVM has no built-in for it, so non-ASCII values - and only those - are
    handed to an Arrow UDF; ASCII values travel as nulls and stay JVM-side.
    """
    c = col(c)
    return F.coalesce(_nfd(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


def strip_accents(c: Column | str) -> Column:
    return F.regexp_replace(decompose(c), r"\p{Mn}", "")


def _swap_distance(a: Column, b: Column) -> Column:
    """Optimal string alignment as two nested folds: over the characters of ``a``, and over a row of the table.

    The state holds the last two rows; what several places need lies in it, too,
    as a lambda computes everything else anew for every cell.
    """
    zero = F.lit(0)
    start = F.struct(
        F.sequence(zero, F.length(b)).alias("row"), F.sequence(zero, F.length(b)).alias("older"),
        F.split(b, "").alias("to"), F.lit("").alias("last"),
    )

    def cell(s: Column, ca: Column, row: Column, j: Column) -> Column:
        cb = F.get(s["to"], j - 1)
        edit = F.get(s["row"], j - 1) + F.when(ca == cb, 0).otherwise(1)
        # without a character before it, either side of the test is null or false
        swap = F.when((ca == F.get(s["to"], j - 2)) & (s["last"] == cb), F.get(s["older"], j - 2) + 1)
        return F.least(F.get(s["row"], j) + 1, F.element_at(row, -1) + 1, edit, swap)

    def step(s: Column, ca: Column) -> Column:
        first = F.array(F.get(s["row"], zero) + 1)
        places = F.sequence(F.lit(1), F.size(s["to"]))
        row = F.aggregate(places, first, lambda row, j: F.concat(row, F.array(cell(s, ca, row, j))))
        return F.struct(row.alias("row"), s["row"].alias("older"), s["to"].alias("to"), ca.alias("last"))

    return F.aggregate(F.split(a, ""), start, step, lambda s: F.element_at(s["row"], -1))


def _neighbours(c: Column) -> Column:
    """All pairs of adjacent characters (shorter texts give themselves)."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda k: F.substr(c, k, F.lit(2)))


def name_distance(a: Column | str, b: Column | str, method: str = "osa") -> Column:
    """Edit distance; ``osa`` counts a swap once, ``levenshtein`` (built in) twice.

    The two differ only where a swap could save an edit: two edits or more, and adjacent
    characters of one text that stand reversed in the other.  Only for such pairs
    the whole table of distances is folded, in the JVM as well.
    """
    a, b = col(a), col(b)
    plain = F.levenshtein(a, b)
    if method == "levenshtein":
        return plain
    if method == "osa":
        swapped = F.transform(_neighbours(b), lambda pair: F.reverse(pair))
        open_ = (plain > 1) & F.arrays_overlap(_neighbours(a), swapped)
        return F.when(open_, _swap_distance(a, b)).otherwise(plain)
    raise ValueError(f"unknown distance {method!r}")


def unique_names(names: list[str | None]) -> list[str]:
    """Header repair: blank names and repeats, whatever their case, get their position as ``...k``."""
    cleaned = [re.sub("�", "", n or "") for n in names]
    times = Counter(n.lower() for n in cleaned)
    return [n if n and times[n.lower()] == 1 else f"{n}...{k}" for k, n in enumerate(cleaned, 1)]
