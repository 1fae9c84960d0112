"""Precinct labels: normalise by rule, then match ballots to returns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.nulls import col, first_match, is_in
from tallyline.functions.text import extract, join_sorted, name_distance, pad_int, replace_first
from tallyline.operators.groups import (
    filter_modes, keep_group_min, null_unless_group_min, tally, with_group_stats,
)
from tallyline.session import written_once

MATCHED_PARTIES = ("DEMOCRAT", "REPUBLICAN")
AREA = ("state", "county_name")
CONTEST = ("office", "district", "party")
#: Widths for the votes of a whole label: powers of two.
SIZE_BANDS = tuple(1 << k for k in range(48))
#: A contest is core where at least this share of a county's returns labels has it.
CORE_SHARE = 0.9


def _apply_steps(label: Column, steps: Sequence[tuple]) -> Column:
    for step in steps:
        kind = step[0]
        if kind == "extract":
            label = extract(label, step[1])
        elif kind == "replace":
            label = replace_first(label, step[1], step[2])
        elif kind == "trim":
            label = F.trim(label)
        elif kind == "int":
            label = pad_int(label, step[1])
        else:
            raise ValueError(f"unknown step {kind!r}")
    return label


def label_rules(state: Column | str, county: Column | str, label: Column | str, rules: Sequence[tuple]) -> Column:
    """Compile (state, counties, steps) entries into one column expression."""
    ladder = []
    for rule_state, counties, steps in rules:
        where = F.lit(True)
        if rule_state is not None:
            where = where & (col(state) == rule_state)
        if counties is not None:
            where = where & is_in(county, counties)
        ladder.append((where, _apply_steps(col(label), steps)))
    return first_match(ladder, col(label))


def ballot_votes(ballots: DataFrame, label: Column) -> DataFrame:
    """Votes per normalised ballot precinct and contest (two main parties).

    Counted per printed label first, so the rules run once per label rather
    than once per ballot.
    """
    counted = tally(
        ballots.where(is_in("party_detailed", MATCHED_PARTIES)).withColumnRenamed("party_detailed", "party"),
        [*AREA, "precinct", *CONTEST],
    )
    return _folded(
        counted.withColumn("label", label).withColumn(
            "district", F.when(F.col("district") == "FEDERAL", F.lit("STATEWIDE")).otherwise(F.col("district"))
        ),
        "n",
    )


def returns_votes(returns: DataFrame, label: Column) -> DataFrame:
    """Votes per normalised returns precinct and contest (two main parties).

    Where a label has several rows for a contest, totals are left out and the
    parts are summed; a lone row counts as it is.
    """
    rows = (
        returns.where(is_in("party_simplified", MATCHED_PARTIES))
        .withColumnRenamed("party_simplified", "party")
        .withColumn("label", label)
    )
    kept = filter_modes(rows, [*AREA, "label", *CONTEST], "keep_parts")
    return _folded(kept.withColumnRenamed("votes", "n"), "n")


def _folded(rows: DataFrame, votes: str) -> DataFrame:
    """One row per (label, contest) with the printed labels it stands for."""
    keys = [*AREA, "label", *CONTEST]
    return rows.where(F.col("label").isNotNull()).groupBy(*keys).agg(
        F.sum(votes).cast("bigint").alias("n"), F.collect_set("precinct").alias("precincts")
    )


def match_precincts(ballots: DataFrame, returns: DataFrame, method: str = "osa") -> DataFrame:
    """Best returns precinct for every ballot precinct of a county.

    Inputs: (state, county_name, label, office, district, party, n, precincts),
    one row per label and contest.  Every pair of labels that shares a contest
    is a candidate; its score is the summed difference of votes over shared
    contests plus the distance of the names.  A label keeps its namesakes, or
    without any the pairs of least score.

    The pairs of a county are never spelled out.  Namesakes come from an equi
    join.  For the rest, one candidate with similar votes gives an upper bound
    of the least score.  A pair at or below it must come within the bound -
    within a fraction of it, where several contests are surely shared - in some
    contest, so a banded equi join finds every pair that could win; those whose
    core contests together stay within the bound are scored.  Both inputs are read by
    several of these steps, so they are written once first.
    """
    ballots, returns = written_once(ballots, "precincts-cvr"), written_once(returns, "precincts-returns")
    left = ballots.where(F.col("label").isNotNull()).select(
        *AREA, F.upper("label").alias("name"), F.col("label").alias("x"), *CONTEST, "n"
    )
    right = returns.where(F.col("label").isNotNull()).select(
        *AREA, F.upper("label").alias("name"), F.col("label").alias("y"), *CONTEST, F.col("n").alias("v")
    )
    namesakes = (
        left.join(right, [*AREA, "name", *CONTEST]).select(*AREA, "x", "y").distinct()
    )
    open_left = left.join(namesakes.select(*AREA, "x").distinct(), [*AREA, "x"], "left_anti")
    near = _near_pairs(open_left, right, method)
    scored = _score(namesakes.unionByName(near), left, right, method)
    # from here on a group is the few pairs one label is left with
    best = keep_group_min(
        # a namesake's score never matters, so it competes with nothing
        scored.withColumn("__namesake", F.col("name_ed_dist") == 0),
        [*AREA, "x"],
        F.when(F.col("__namesake"), F.lit(-1)).otherwise(F.col("discrepancy") + F.col("name_ed_dist")),
        bounded=True,
    ).drop("__namesake")
    labelled = _with_printed(best, ballots, returns)
    blanked = null_unless_group_min(
        labelled,
        [*AREA, "y"],
        "discrepancy",
        ["precinct_returns", "discrepancy", "prec_votes", "name_ed_dist", "y"],
        F.col("name_ed_dist") == 0,
        bounded=True,
    )
    counted = with_group_stats(blanked, [*AREA, "precinct_cvr"], bounded=True, times=F.count("precinct_returns"))
    return counted.select(
        *AREA, "precinct_cvr", "precinct_returns", F.col("x").alias("label_cvr"), F.col("y").alias("label_returns"),
        "discrepancy", "cvr_votes", "prec_votes", "offices", "name_ed_dist", "times",
    )


def _bands(most: int) -> list[int]:
    """Widths in powers of eight, the last one wide enough for the largest difference."""
    widths = [1]
    while widths[-1] < most:
        widths.append(widths[-1] * 8)
    return widths


def _core_contests(right: DataFrame) -> DataFrame:
    """Per county the contests (a list) that nearly all of its returns labels have."""
    labels = right.groupBy(*AREA).agg(F.count_distinct("y").alias("n_labels"))
    core = (
        right.dropna(subset=[*CONTEST]).groupBy(*AREA, *CONTEST).agg(F.count(F.lit(1)).alias("n_with")).join(labels, list(AREA))
        .where(F.col("n_with") >= F.lit(CORE_SHARE) * F.col("n_labels"))
    )
    return core.groupBy(*AREA).agg(F.array_sort(F.collect_list(F.struct(*CONTEST))).alias("core"))


def _vectors(side: DataFrame, label: str, votes: str, core: DataFrame) -> DataFrame:
    """Per label its votes in the county's core contests, in one order, null where it lacks one."""
    own = F.map_from_entries(F.collect_list(F.struct(F.struct(*CONTEST).alias("contest"), F.col(votes).alias("votes"))))
    listed = side.dropna(subset=[*CONTEST]).groupBy(*AREA, label).agg(own.alias("own")).join(core, list(AREA))
    return listed.select(*AREA, label, F.transform("core", lambda contest: F.try_element_at("own", contest)).alias("vector"))


def _core_distance(one: Column | str, other: Column | str) -> Column:
    """Summed difference over the core contests both labels have: never above the discrepancy."""
    apart = F.zip_with(one, other, lambda p, q: F.coalesce(F.abs(p - q), F.lit(0).cast("bigint")))
    return F.coalesce(F.aggregate(apart, F.lit(0).cast("bigint"), lambda total, d: total + d), F.lit(0).cast("bigint"))


def _near_pairs(left: DataFrame, right: DataFrame, method: str) -> DataFrame:
    """All pairs whose score may be the least of their ballot label (a superset).

    The votes of a label's core contests travel with it as a vector, so a pair
    that meets in a band is measured over all of them inside the join; only
    pairs within the bound are shuffled and scored.
    """
    contest = [*AREA, *CONTEST]
    counts = left.select("n").unionByName(right.select(F.col("v").alias("n")))
    widths = _bands(counts.agg(F.max("n") - F.least(F.min("n"), F.lit(0))).head()[0] or 0)
    core = _core_contests(right)
    x_vector, y_vector = _vectors(left, "x", "n", core), _vectors(right, "y", "v", core)

    def band(votes: str, widths: Sequence[int]) -> Column:
        return F.explode(
            F.array(*[F.struct(F.lit(w).alias("w"), F.floor(F.col(votes) / F.lit(w)).alias("b")) for w in widths])
        )

    def guess(x: DataFrame, y: DataFrame, keys: Sequence[str], meeting: Callable[[], Column], per: Sequence[str] = ()) -> DataFrame:
        """Per ballot label (and ``per``) the returns label it meets in the narrowest band."""
        sample = y.select(*keys, "y", meeting().alias("k")).groupBy(*keys, "k").agg(F.min("y").alias("y"))
        met = x.select(*keys, "x", meeting().alias("k")).join(sample, [*keys, "k"])
        return met.groupBy(*AREA, *per, "x").agg(F.min(F.struct("k.w", "y")).alias("best")).select(*AREA, "x", "best.y")

    def planes() -> Column:
        """Cells of every two neighbouring core contests: few labels share one, so the one met is often the match."""
        at = F.sequence(F.lit(0), F.size("vector") - 1)
        cell = lambda k, w: F.struct(
            F.lit(w).alias("w"), F.floor(F.get("vector", k) / F.lit(w)).alias("b"),
            F.floor(F.get("vector", (k + 1) % F.size("vector")) / F.lit(w)).alias("c"), k.alias("at"),
        )
        cells = F.flatten(F.transform(at, lambda k: F.array(*[cell(k, w) for w in widths])))
        return F.explode(F.filter(cells, lambda c: c["b"].isNotNull() & c["c"].isNotNull()))

    # guesses bound the least score: a label of similar size, and - since that one may
    # share no contest - a label met in some contest, and one per plane of core contests
    sizes = (
        left.groupBy(*AREA, "x").agg(F.sum("n").alias("size")),
        right.groupBy(*AREA, "y").agg(F.sum("v").alias("size")),
    )
    guesses = (
        guess(*sizes, AREA, lambda: band("size", SIZE_BANDS))
        .unionByName(guess(left, right.withColumnRenamed("v", "n"), contest, lambda: band("n", widths)))
        .unionByName(guess(x_vector, y_vector, AREA, planes, ["k.at"]))
    ).distinct()
    bound = _score(guesses, left, right, method).groupBy(*AREA, "x").agg(
        F.min(F.col("discrepancy") + F.col("name_ed_dist")).alias("bound")
    )
    # a returns label that has every core contest shares all of x's core contests,
    # so one of those differs by at most the bound over their number
    offered = right.join(y_vector.withColumnRenamed("vector", "y_vector"), [*AREA, "y"], "left").select(
        *contest, "y", "v", "y_vector", F.coalesce(~F.exists("y_vector", lambda v: v.isNull()), F.lit(False)).alias("whole"),
        band("v", widths).alias("k"),
    ).select(*contest, "y", "v", "y_vector", "whole", "k.w", "k.b")
    own = x_vector.withColumnRenamed("vector", "x_vector").join(core, list(AREA))
    known = left.join(own, [*AREA, "x"], "left").join(bound, [*AREA, "x"])
    n_core = F.coalesce(F.size(F.filter("x_vector", lambda v: v.isNotNull())), F.lit(0))
    in_core = F.coalesce(F.array_contains("core", F.struct(*CONTEST)), F.lit(False))
    by_core = F.col("whole") & (F.col("n_core") > 0)
    wanted = (
        known.withColumns({"n_core": n_core, "in_core": in_core}).drop("core")
        .select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("whole"))
        .where(~by_core | F.col("in_core"))
        .withColumn("parts", F.when(by_core, F.col("n_core")).otherwise(1))
        # no two counts are further apart than the last width
        .withColumn("reach", F.least(F.floor(F.col("bound") / F.col("parts")), F.lit(widths[-1])))
    )
    # the narrowest width not below the reach: at most three bands cover the range
    width = F.coalesce(*[F.when(F.lit(w) >= F.col("reach"), F.lit(w)) for w in widths])
    low, high = (F.floor((F.col("n") + sign * F.col("reach")) / F.col("w")) for sign in (-1, 1))
    spread = wanted.withColumn("w", width).withColumn("b", F.explode(F.sequence(low, high)))
    # names that differ in length by k are at least k edits apart
    spelled = F.abs(F.length(F.upper("x")) - F.length(F.upper("y")))
    apart = F.abs(F.col("n") - F.col("v"))
    near = (apart <= F.col("reach")) & (apart + spelled <= F.col("bound"))
    found = spread.join(offered, [*contest, "whole", "w", "b"]).where(near).where(
        _core_distance("x_vector", "y_vector") + spelled <= F.col("bound")
    )
    return found.select(*AREA, "x", "y").distinct()


def _score(pairs: DataFrame, left: DataFrame, right: DataFrame, method: str) -> DataFrame:
    """Score candidate pairs over the contests both labels have."""
    shared = pairs.join(left.drop("name"), [*AREA, "x"]).join(right.drop("name"), [*AREA, "y", *CONTEST])
    folded = shared.groupBy(*AREA, "x", "y").agg(
        F.sum(F.abs(F.col("n") - F.col("v"))).alias("discrepancy"),
        F.sum("n").alias("cvr_votes"),
        F.sum("v").alias("prec_votes"),
        join_sorted(F.collect_set("office")).alias("offices"),
    )
    return folded.withColumn("name_ed_dist", name_distance(F.upper("x"), F.upper("y"), method))


def _with_printed(pairs: DataFrame, ballots: DataFrame, returns: DataFrame) -> DataFrame:
    def printed(side: DataFrame, name: str, label: str) -> DataFrame:
        return side.groupBy(*AREA, F.col("label").alias(label)).agg(
            join_sorted(F.flatten(F.collect_set("precincts"))).alias(name)
        )

    return pairs.join(printed(ballots, "precinct_cvr", "x"), [*AREA, "x"]).join(
        printed(returns, "precinct_returns", "y"), [*AREA, "y"]
    )
