"""Grouped operators.

A group statistic is attached to rows by aggregating and joining back, not by a
window: the aggregation combines map-side, so a group that holds a third of all
rows shrinks to one row per task before the shuffle, and the join back is
either broadcast by AQE (measured size) or split by its skew handling.  A window
would move the whole group into a single task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.nulls import all_true, any_true, col, holds, sum0
from tallyline.operators.joins import join_null_safe
from tallyline.session import written_once


def with_group_stats(df: DataFrame, keys: Sequence[str], bounded: bool = False, **stats: Column) -> DataFrame:
    """Every row plus its group's statistics; null keys form a group of their own.

    ``bounded`` is for tables already folded so far that a group is short (the
    counties of a state, the parties of a precinct): a window then reads the
    table once, where the default reads it twice.
    """
    if not keys:
        raise ValueError("group keys needed")
    if bounded:
        whole = Window.partitionBy(*keys)
        return df.withColumns({n: s.over(whole) for n, s in stats.items()})
    folded = df.groupBy(*keys).agg(*[s.alias(n) for n, s in stats.items()])
    return join_null_safe(df, folded, keys, "inner")


def sum_by(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """Group sum over known values; a group without any gives 0."""
    return df.groupBy(*keys).agg(sum0(value).alias(name or value))


def tally(df: DataFrame, keys: Sequence[str], name: str = "n", weight: str | None = None) -> DataFrame:
    """Row count, or weighted count, per group."""
    total = sum0(weight) if weight else F.count(F.lit(1))
    return df.groupBy(*keys).agg(total.alias(name))


def two_level_sum(df: DataFrame, keys: Sequence[str], detail: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Sum per (keys, detail), and the same re-aggregated to keys."""
    fine = sum_by(df, [*keys, detail], value)
    return fine, sum_by(fine, keys, value)


def count_of_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys occur once, twice, ...: ``n`` and ``nn``."""
    return tally(tally(df, keys, "n"), ["n"], "nn")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first full row of each key in the given order.

    A minimum over structs combines map-side, so duplicates are dropped before
    the shuffle and a hot key never gathers in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in [*order, *rest]])
    folded = df.groupBy(*keys).agg(F.min(packed).alias("__first"))
    return folded.select(*[F.col(c) if c in keys else F.col(f"__first.{c}").alias(c) for c in df.columns])


def singletons(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs exactly once."""
    return keep_group_size(df, keys, F.col("__n") == 1)


def keep_group_size(df: DataFrame, keys: Sequence[str], condition: Column) -> DataFrame:
    """Rows whose group size (``__n``) meets the condition."""
    wanted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(condition).select(*keys)
    return join_null_safe(df, wanted, keys, "left_semi")


def filter_modes(
    df: DataFrame, keys: Sequence[str], rule: str, mode: str = "mode", total: str = "TOTAL", bounded: bool = False
) -> DataFrame:
    """Rows counted twice because a total stands next to its parts.

    ``drop_parts``: where a total exists, keep only totals.
    ``keep_parts``: in groups of more than one row keep the parts; a lone row stays.
    ``total_only``: like ``drop_parts`` but an unknown mode counts as a part.
    ``drop_mixed``: drop groups that hold both kinds.
    """
    is_total = F.col(mode) == total
    has_total, has_part = F.col("__total"), F.col("__part")
    keep = {
        "drop_parts": ~(has_total & holds(~is_total)),
        "keep_parts": (F.col("__size") == 1) | holds(~is_total),
        "total_only": ~has_total | holds(is_total),
        "drop_mixed": ~(has_total & has_part),
    }
    if rule not in keep:
        raise ValueError(f"unknown rule {rule!r}")
    facts = {
        "__total": F.bool_or(holds(is_total)), "__part": F.bool_or(holds(~is_total)), "__size": F.count(F.lit(1)),
    }
    return with_group_stats(df, keys, bounded, **facts).where(keep[rule]).drop(*facts)


def keep_group_min(df: DataFrame, keys: Sequence[str], measure: Column, bounded: bool = False) -> DataFrame:
    """Rows whose measure equals the least of their group."""
    measured = df.withColumn("__m", measure)
    return with_group_stats(measured, keys, bounded, __least=F.min("__m")).where("__m = __least").drop("__m", "__least")


def null_unless_group_min(
    df: DataFrame, keys: Sequence[str], measure: str, columns: Sequence[str], exempt: Column, bounded: bool = False
) -> DataFrame:
    """Blank columns of rows that are neither the group's least nor exempt.

    The condition is computed once from the original values.
    """
    stats = with_group_stats(df, keys, bounded, __least=F.min(measure))
    beaten = stats.withColumn("__beaten", holds((F.col(measure) != F.col("__least")) & ~exempt))
    return beaten.withColumns({c: F.when(~F.col("__beaten"), F.col(c)) for c in columns}).drop("__least", "__beaten")


def keep_group_any(df: DataFrame, keys: Sequence[str], condition: Column) -> DataFrame:
    """All rows of the groups in which some row meets the condition."""
    wanted = df.where(condition).select(*keys).distinct()
    return join_null_safe(df, wanted, keys, "left_semi")


def rank_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "cand_rank") -> DataFrame:
    """1, 2, 3, ... within a group.

    Meant for tables already folded to one row per (group, candidate), where a
    group is as long as a contest's list of candidates; end ``order`` with a
    unique column so that ranks are reproducible.
    """
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def running_number(df: DataFrame, keys: Sequence[str], index: str, name: str, stretch: int = 1 << 16) -> DataFrame:
    """1, 2, 3, ... within a group by an integer index, in bounded pieces.

    Rows are numbered inside ranges of ``stretch`` index values and shifted by
    the rows of the ranges before, so a group of any size spreads over tasks.
    """
    pieces = df.withColumn("__piece", F.floor(F.col(index) / stretch))
    inside = Window.partitionBy(*keys, "__piece").orderBy(index)
    before = Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieces.groupBy(*keys, "__piece").agg(F.count(F.lit(1)).alias("__size"))
    shifts = sizes.withColumn("__shift", F.coalesce(F.sum("__size").over(before), F.lit(0))).drop("__size")
    numbered = join_null_safe(pieces.withColumn("__k", F.row_number().over(inside)), shifts, [*keys, "__piece"], "inner")
    return numbered.withColumn(name, F.col("__shift") + F.col("__k")).drop("__piece", "__shift", "__k")


def dense_ids(df: DataFrame, keys: Sequence[str], name: str = "id", buckets: int = 1 << 16) -> DataFrame:
    """Number the distinct keys 1..n without a global sort; keys plus ``name``.

    Distinct keys hash evenly into a fixed number of buckets, are numbered
    inside their bucket, and shifted by the sizes of the buckets before.  The
    number depends on the keys only, so a recomputed task gives the same ids.
    """
    distinct = df.select(*keys).distinct().withColumn("__b", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    numbered = distinct.withColumn("__k", F.row_number().over(Window.partitionBy("__b").orderBy(*keys)))
    sizes = distinct.groupBy("__b").agg(F.count(F.lit(1)).alias("__size"))
    # at most `buckets` rows reach this ordered window
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("__b", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__shift"))
    return numbered.join(shift, "__b").select(*keys, (F.col("__shift") + F.col("__k")).alias(name))


def ordered_ids(df: DataFrame, key: str, name: str = "id") -> DataFrame:
    """Number the distinct values of ``key`` 1..n in their order; ``key`` plus ``name``.

    Values are dealt into ranges, numbered inside theirs and shifted by the
    sizes of the ranges before.  The ranges are written once, so that every
    later reading sees the same cut.
    """
    cut = df.select(key).distinct().repartitionByRange(F.col(key)).withColumn("__range", F.spark_partition_id())
    ranged = written_once(cut, "ranges")
    sizes = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
    # one row per range reaches this ordered window
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__shift"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(key))
    return ranged.withColumn("__k", inside).join(shift, "__range").select(key, (F.col("__shift") + F.col("__k")).alias(name))


def attach_ids(df: DataFrame, keys: Sequence[str], name: str = "id", buckets: int = 1 << 16, once: bool = False) -> DataFrame:
    """Rows plus the dense id of their key (a dense group id).

    ``once`` writes the ids before the join, so that the exchanges that number
    the keys can be freed before the rows are shuffled.
    """
    ids = dense_ids(df, keys, name, buckets)
    return join_null_safe(df, written_once(ids, "ids", "zstd") if once else ids, keys, "inner")


def rollup_totals(df: DataFrame, key: str, label: str, **measures: Column) -> DataFrame:
    """Per-key figures plus a labelled grand-total row, in one aggregation.

    ``is_total`` marks the total; address it by that, never by position.
    """
    return (
        df.rollup(key)
        .agg(F.grouping(key).cast("int").alias("is_total"), *[m.alias(n) for n, m in measures.items()])
        .withColumn(key, F.when(F.col("is_total") == 1, F.lit(label)).otherwise(F.col(key)))
    )


def crosstab_margins(df: DataFrame, a: str, b: str, label: str = "Sum") -> DataFrame:
    """Cross table in long form with margins labelled ``label``."""
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    # the cube expands each row fourfold, so it runs over cells, not over rows
    cube = cells.cube(a, b).agg(
        F.sum("n").alias("n"), F.grouping(a).alias("__ga"), F.grouping(b).alias("__gb")
    )
    return cube.select(
        F.when(F.col("__ga") == 1, F.lit(label)).otherwise(F.col(a).cast("string")).alias(a),
        F.when(F.col("__gb") == 1, F.lit(label)).otherwise(F.col(b).cast("string")).alias(b),
        "n",
    )


def width_histogram(df: DataFrame, value: str, width: float, by: Sequence[str] = ()) -> DataFrame:
    """Fixed-width bins from 0 with each bin's share of all rows.

    Only the bins - bounded by value range over width - meet in the total.
    """
    binned = df.where(F.col(value).isNotNull()).withColumn("bin", F.floor(F.col(value) / F.lit(width)))
    bins = binned.groupBy("bin", *by).agg(F.count(F.lit(1)).alias("n"))
    return bins.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def row_sum(*columns: Column | str) -> Column:
    """Row-wise sum in which a missing cell counts 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(col(c), F.lit(0)) for c in columns])


def row_match_rate(columns: Sequence[Column | str], target) -> Column:
    """Share of a row's known cells equal to ``target``; null when none is known."""
    hits = reduce(lambda a, b: a + b, [F.when(col(c) == target, 1).otherwise(0) for c in columns])
    known = reduce(lambda a, b: a + b, [F.when(col(c).isNotNull(), 1).otherwise(0) for c in columns])
    return F.try_divide(hits, known)


def distinct_exact(c: Column | str, count_null: bool = False) -> Column:
    """Exact distinct count; optionally null counts as one more value."""
    counted = F.count_distinct(col(c))
    return counted + F.max(F.when(col(c).isNull(), 1).otherwise(0)) if count_null else counted


def variable_summary(
    df: DataFrame, variables: Sequence[str], weight: str, accuracy: int = 100_000
) -> DataFrame:
    """One row per variable: weighted mean, mean, exact median, sample deviation.

    The variables are stacked and folded together.  The median is exact without
    gathering values: a sketch brackets the middle ranks, everything outside
    the bracket is only counted, and the distinct values inside - a few per
    ``accuracy`` of the rows - are walked in order.
    """
    long = df.select(F.col(weight).alias("__w"), *[F.col(v).cast("double").alias(v) for v in variables]).unpivot(
        ["__w"], list(variables), "Variable", "x"
    )
    known = long.where(F.col("x").isNotNull())
    margin = 3 / accuracy
    base = known.groupBy("Variable").agg(
        (F.sum(F.col("x") * F.col("__w")) / F.sum("__w")).alias("Total"),
        F.avg("x").alias("Mean"),
        F.stddev_samp("x").alias("SD"),
        F.count("x").alias("__n"),
        F.percentile_approx("x", [0.5 - margin, 0.5 + margin], accuracy).alias("__bracket"),
    )
    base = written_once(base, "brackets")  # a row per variable
    low, high = F.col("__bracket")[0], F.col("__bracket")[1]
    side = F.when(F.col("x") < low, -1).when(F.col("x") > high, 1).otherwise(0)
    placed = known.join(F.broadcast(base.select("Variable", "__bracket")), "Variable").withColumn("__side", side)
    folded = placed.groupBy("Variable", "__side", F.when(F.col("__side") == 0, F.col("x")).alias("__v")).agg(
        F.count(F.lit(1)).alias("__c"), F.min("x").alias("__min"), F.max("x").alias("__max")
    )
    walk = Window.partitionBy("Variable").orderBy("__side", "__v")
    walked = folded.withColumn("__to", F.sum("__c").over(walk)).join(base.select("Variable", "__n"), "Variable")
    came = F.col("__to") - F.col("__c")

    def at(rank: Column) -> Column:
        # outside the bracket only the value next to it can be a middle one
        here = (rank > came) & (rank <= F.col("__to"))
        edge = F.when((F.col("__side") == -1) & (rank == F.col("__to")), F.col("__max")).when(
            (F.col("__side") == 1) & (rank == came + 1), F.col("__min")
        )
        return F.max(F.when(here, F.when(F.col("__side") == 0, F.col("__v")).otherwise(edge)))

    first, second = F.floor((F.col("__n") + 1) / 2), F.floor(F.col("__n") / 2) + 1
    picked = walked.groupBy("Variable").agg(at(first).alias("__m1"), at(second).alias("__m2"))
    return base.join(picked, "Variable").select(
        "Variable", "Total", "Mean", ((F.col("__m1") + F.col("__m2")) / 2).alias("Median"), "SD"
    )


def group_truth(df: DataFrame, keys: Sequence[str], **conditions: Column) -> DataFrame:
    """Per group, for each condition: ``all_*`` and ``any_*`` over known truths."""
    folded = []
    for name, condition in conditions.items():
        folded += [all_true(condition).alias(f"all_{name}"), any_true(condition).alias(f"any_{name}")]
    return df.groupBy(*keys).agg(*folded)
