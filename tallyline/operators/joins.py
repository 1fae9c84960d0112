"""Join operators.

No operator forces a broadcast: Catalyst broadcasts a side whose size it knows
to be small, and AQE does so from the size measured at run time.  Anything
larger is shuffled, and AQE splits the partitions of a skewed key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ONE_SIDED = {
    "one-to-one": ("left", "right"),
    "many-to-one": ("right",),
    "one-to-many": ("left",),
    "many-to-many": (),
}


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Key equality in which two nulls match, still a hash/merge equi join."""
    condition = None
    for key in keys:
        pair = left[key].eqNullSafe(right[key])
        condition = pair if condition is None else condition & pair
    return condition


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi join on same-named keys in which null matches null."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = None
    for key in keys:
        pair = left[key].eqNullSafe(renamed[f"__r_{key}"])
        condition = pair if condition is None else condition & pair
    joined = left.join(renamed, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how in ("right", "full"):
        merged = {k: F.coalesce(F.col(k), F.col(f"__r_{k}")) for k in keys}
        joined = joined.withColumns(merged)
    return joined.drop(*[f"__r_{k}" for k in keys])


def join_differing_keys(left: DataFrame, right: DataFrame, keys: dict[str, str], how: str = "left") -> DataFrame:
    """Equi join whose keys are named differently; the right names are dropped."""
    renamed = right.withColumnsRenamed({r: f"__r_{r}" for r in keys.values()})
    condition = [left[l] == renamed[f"__r_{r}"] for l, r in keys.items()]
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__r_{r}" for r in keys.values()])


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every shared column name."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("no shared column to join on")
    return left.join(right, shared, how)


def repeated_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (partial aggregation, so a hot key is cheap)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _proved_once(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``df``, folded by its keys; a key that occurs twice ends the query that reads it."""
    rest = [c for c in df.columns if c not in keys]
    row = [F.first(F.struct(*rest)).alias("__row")] if rest else []
    folded = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *row)
    repeats = F.concat(F.lit(f"{what} key repeats: "), F.to_json(F.struct(*keys)))
    once = F.when(F.col("__n") > 1, F.raise_error(repeats).cast("boolean")).otherwise(F.lit(True))
    return folded.where(once).select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def checked_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", relationship: str = "many-to-one"
) -> DataFrame:
    """Equi join that proves the declared relationship as it runs.

    Each "one" side is folded by the join key, which the join needs it dealt by
    anyway, with a count that must be one; planning runs no job.
    """
    sides = {"left": left, "right": right}
    for side in ONE_SIDED[relationship]:
        sides[side] = _proved_once(sides[side], keys, f"{relationship} join: {side}")
    return sides["left"].join(sides["right"], list(keys), how)


def star_lookup(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """Left join a fact table to several dimensions, each with its own key names."""
    for dimension, keys in dimensions:
        fact = join_differing_keys(fact, dimension, keys, "left")
    return fact


def override(df: DataFrame, external: DataFrame, keys: Sequence[str], value: str, external_value: str) -> DataFrame:
    """External totals replace own ones where there is one (one-to-one)."""
    joined = checked_join(df, external, keys, "left", "one-to-one")
    return joined.withColumn(value, F.coalesce(external_value, value)).drop(external_value)


def fill(df: DataFrame, metadata: DataFrame, keys: Sequence[str], value: str, check: bool = True) -> DataFrame:
    """Own value wins; metadata only fills what is missing (many-to-one)."""
    meta = metadata.select(*keys, F.col(value).alias("__meta"))
    joined = checked_join(df, meta, keys, "left", "many-to-one") if check else df.join(meta, list(keys), "left")
    return joined.withColumn(value, F.coalesce(value, "__meta")).drop("__meta")


def metadata_wins(
    df: DataFrame, metadata: DataFrame, keys: Sequence[str], value: str, exclude_flag: str = "issue"
) -> DataFrame:
    """Metadata value wins; rows whose metadata carries a flag are dropped.

    Metadata keys may repeat (one row per spelling), as in the hand-made file.
    """
    meta = metadata.withColumnRenamed(value, "__meta")
    joined = df.join(meta, list(keys), "left").where(F.col(exclude_flag).isNull())
    return joined.withColumn(value, F.coalesce("__meta", value)).drop("__meta")


def redact(
    df: DataFrame, groups: DataFrame, keys: Sequence[str], labels: dict[str, str], check: bool = True
) -> DataFrame:
    """Replace a label by its privacy group where the record is listed.

    ``labels`` maps the column to redact to the group column that replaces it.
    """
    distinct_groups = groups.distinct()
    joined = (
        checked_join(df, distinct_groups, keys, "left", "many-to-one")
        if check
        else df.join(distinct_groups, list(keys), "left")
    )
    replaced = joined.withColumns({c: F.coalesce(g, c) for c, g in labels.items()})
    return replaced.drop(*labels.values())


def remap_ids(
    records: DataFrame, info: DataFrame, key: str, merged: str, required: Sequence[str]
) -> DataFrame:
    """Give split records their merged id.

    The id list drives: records it does not list vanish, and so do listed ids
    without a record (their required columns are null).
    """
    mapping = info.where(F.col(key).isNotNull()).select(key, merged).distinct()
    joined = checked_join(mapping, records, [key], "left", "one-to-many")
    return joined.withColumn(key, F.coalesce(merged, key)).drop(merged).dropna(subset=list(required))


def stack_sides(keys: Sequence[str], **sides: DataFrame) -> DataFrame:
    """Full-outer alignment of several one-row-per-key tables in one shuffle.

    Instead of a chain of full joins the sides are tagged, unioned and folded
    by key.  Grouping treats null keys as equal, combines map-side, and costs
    one exchange however many sides there are.  Yields ``in_{side}`` flags plus
    each side's columns suffixed ``_{side}``.
    """
    tagged = [
        df.select(*keys, F.lit(side).alias("__side"), *[c for c in df.columns if c not in keys])
        for side, df in sides.items()
    ]
    everything = tagged[0]
    for df in tagged[1:]:
        everything = everything.unionByName(df, allowMissingColumns=True)
    folded = []
    for side, df in sides.items():
        here = F.col("__side") == side
        folded.append(F.bool_or(here).alias(f"in_{side}"))
        folded += [F.max(F.when(here, F.col(c))).alias(f"{c}_{side}") for c in df.columns if c not in keys]
    return everything.groupBy(*keys).agg(*folded)


def prefer_sources(
    base: DataFrame, other: DataFrame, keys: Sequence[str], swapped: DataFrame, removed: DataFrame | None = None
) -> DataFrame:
    """Source precedence: base without the removed and swapped keys, plus the
    other source for the swapped ones."""
    kept = base.join(swapped.select(*keys), list(keys), "left_anti")
    if removed is not None:
        kept = kept.join(removed.select(*keys), list(keys), "left_anti")
    taken = other.join(swapped.select(*keys), list(keys), "left_semi")
    return kept.unionByName(taken, allowMissingColumns=True)


def drop_around(df: DataFrame, index: str, marks: DataFrame, before: int = 1, after: int = 2) -> DataFrame:
    """Range anti join: drop rows whose index lies within reach of a mark.

    The range has a fixed width, so each mark is spelled out into the few index
    values it covers and the range test becomes a plain equi anti join.
    """
    covered = marks.select(F.explode(F.sequence(F.col(index) - before, F.col(index) + after)).alias(index)).distinct()
    return df.join(covered, index, "left_anti")


def pair_differences(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Over all (left, right) pairs of a key: how many, and the sum of |difference|.

    The many-to-many join itself is never formed.  Both sides are folded to
    counts per value; walking the values upwards, each step adds the distance
    to the next value times the pairs it separates.
    """
    sides = left.select(*keys, F.col(value).alias("__x"), F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionByName(
        right.select(*keys, F.col(value).alias("__x"), F.lit(0).alias("__l"), F.lit(1).alias("__r"))
    )
    values = sides.groupBy(*keys, "__x").agg(F.sum("__l").alias("__l"), F.sum("__r").alias("__r"))
    totals = values.groupBy(*keys).agg(F.sum("__l").alias("__tl"), F.sum("__r").alias("__tr"))
    order = Window.partitionBy(*keys).orderBy("__x")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    walked = values.select(
        *keys,
        (F.lead("__x").over(order) - F.col("__x")).alias("__step"),
        F.sum("__l").over(upto).alias("__cl"),
        F.sum("__r").over(upto).alias("__cr"),
    )
    # pairs with one value up to here and the other beyond
    apart = F.col("__cl") * (F.col("__tr") - F.col("__cr")) + F.col("__cr") * (F.col("__tl") - F.col("__cl"))
    return (
        walked.join(totals.where("__tl > 0 AND __tr > 0"), list(keys))
        .groupBy(*keys)
        .agg(
            F.max(F.col("__tl") * F.col("__tr")).alias("n_pairs"),
            F.coalesce(F.sum(F.col("__step") * apart), F.lit(0)).cast("bigint").alias("discrepancy"),
        )
    )
