"""Projection operators: select, rename, drop, fill in, apply across."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_matching(df: DataFrame, *patterns: str) -> DataFrame:
    """Keep the columns whose name matches any pattern, in table order."""
    return df.select(*[c for c in df.columns if any(re.search(p, c) for p in patterns)])


def drop_matching(df: DataFrame, *patterns: str) -> DataFrame:
    return df.select(*[c for c in df.columns if not any(re.search(p, c) for p in patterns)])


def rename_aliases(df: DataFrame, canonical: str, aliases: Iterable[str]) -> DataFrame:
    """Rename whichever known alias is present to one canonical name.

    Two aliases in one table would give two columns of one name: an error.
    """
    present = [a for a in aliases if a in df.columns]
    if len(present) > 1 or (present and canonical in df.columns and present != [canonical]):
        raise ValueError(f"more than one column for {canonical!r}: {present}")
    return df.withColumnRenamed(present[0], canonical) if present else df


def rename(df: DataFrame, **new_to_old: str) -> DataFrame:
    return df.withColumnsRenamed({old: new for new, old in new_to_old.items()})


def drop_known(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop metadata columns; names that are absent are ignored."""
    return df.drop(*[n for n in names if n in df.columns])


def add_literals(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def select_optional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    return df.select(*[n for n in names if n in df.columns])


def add_missing(df: DataFrame, names: Iterable[str], kind: str = "string") -> DataFrame:
    """Add the listed columns that do not exist, as nulls."""
    return df.withColumns({n: F.lit(None).cast(kind) for n in names if n not in df.columns})


def reorder(df: DataFrame, first: Sequence[str] = (), after: str | None = None) -> DataFrame:
    """Move columns to the front, or behind column ``after``."""
    moved = [c for c in first if c in df.columns]
    rest = [c for c in df.columns if c not in moved]
    at = rest.index(after) + 1 if after else 0
    return df.select(*rest[:at], *moved, *rest[at:])


def apply_across(df: DataFrame, names: Iterable[str], fn: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({n: fn(F.col(n)) for n in names})


def coalesce_pair(df: DataFrame, target: str, *sources: str) -> DataFrame:
    """First known value of the sources becomes ``target``; the others go."""
    merged = df.withColumn("__merged", F.coalesce(*[F.col(s) for s in sources]))
    return merged.drop(*sources, target).withColumnRenamed("__merged", target)


def ordered_rank(c: Column | str, levels: Sequence[str]) -> Column:
    """Position of a category in a fixed order, for sorting; unknown is null."""
    pairs = [p for k, level in enumerate(levels, 1) for p in (F.lit(level), F.lit(k))]
    return F.try_element_at(F.create_map(*pairs), F.col(c) if isinstance(c, str) else c)


def scale_factor(condition: Column, factor: float) -> Column:
    """Weight for a multi-member contest, 1 elsewhere (also where unknown)."""
    return F.when(condition, F.lit(float(factor))).otherwise(F.lit(1.0))
