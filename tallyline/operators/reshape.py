"""Wide/long reshaping and nested-field access."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_long(
    df: DataFrame, ids: Sequence[str], name: str, value: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per (row, column) with a known value; nulls vanish at once."""
    measured = list(columns) if columns is not None else [c for c in df.columns if c not in ids]
    quoted = [F.col(f"`{c}`") for c in measured]
    return df.unpivot([F.col(f"`{c}`") for c in ids], quoted, name, value).where(F.col(value).isNotNull())


def to_wide(
    df: DataFrame, ids: Sequence[str], names_from: str, names: Sequence[str], measures: dict[str, Column]
) -> DataFrame:
    """One row per id; a column ``{name}_{measure}`` per fixed name and aggregate.

    The names are fixed up front, so no extra job runs to discover them and the
    schema does not depend on the data.
    """
    return df.groupBy(*ids).pivot(names_from, list(names)).agg(*[a.alias(m) for m, a in measures.items()])


def unnest(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """One row per list element; rows with an empty or missing list vanish."""
    target = name or column
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(column).alias(target))


def hoist(df: DataFrame, source: str, fields: dict[str, Sequence[str | int]]) -> DataFrame:
    """Pull nested fields into columns; a path step is a field name or a list position.

    List positions count from 1; a missing element gives null.
    """

    def walk(path: Sequence[str | int]) -> Column:
        c = F.col(source)
        for step in path:
            c = F.try_element_at(c, F.lit(step)) if isinstance(step, int) else c.getField(step)
        return c

    return df.withColumns({name: walk(path) for name, path in fields.items()})
