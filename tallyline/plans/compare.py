"""Tallies by source against official returns: alignment, classes, release flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.nulls import all_true, any_true, is_in, not_in, recode, strict_sum, sum0
from tallyline.operators.columns import ordered_rank
from tallyline.operators.groups import crosstab_margins, keep_group_any, rank_in_group, row_match_rate, tally
from tallyline.operators.joins import stack_sides
from tallyline.operators.reshape import to_wide
from tallyline.rules import vocabulary as V
from tallyline.session import written_once

COUNTY = ("state", "county_name")
CONTEST = (*COUNTY, "office", "district", "party_detailed")
ALIGNED = (*CONTEST, "cand_rank")

#: Classes of a county, from exact to unusable.
CLASSES = (
    "0 difference", "any < 1% mismatch", "any < 5% mismatch", "any < 10% mismatch",
    "candidate missing", "not collected", "no entry in returns", "red", "unclassified",
)
RELEASABLE = ("any < 1% mismatch", "0 difference")
#: Counties whose class is set by hand.
SET_BY_HAND = {("COLORADO", "ARAPAHOE"): "unclassified"}


def ranked_tally(
    rows: DataFrame,
    parties: Sequence[str] = V.COMPARED_PARTIES,
    weight: str | None = None,
    relabel: bool = True,
    extra_keys: Sequence[str] = (),
) -> DataFrame:
    """Votes per candidate and their rank inside (contest, party).

    Rows are relabelled in place and counted in one pass, so what is ranked is
    one row per candidate.  Choices without a candidate become parties of their own when
    ``relabel``; equal votes are ordered by name.
    """
    if relabel:
        own = is_in("candidate", ("UNDERVOTE", "WRITEIN", "OVERVOTE"))
        rows = rows.withColumns(
            {
                "party_detailed": F.when(own, F.col("candidate")).otherwise(F.col("party_detailed")),
                "county_name": F.when(is_in("state", V.STATEWIDE_STATES), F.lit("STATEWIDE")).otherwise(F.col("county_name")),
            }
        )
    kept = rows.where(is_in("party_detailed", parties))
    counted = tally(kept, [*COUNTY, "office", "district", "candidate", "party_detailed", *extra_keys], "votes", weight)
    return rank_in_group(counted, CONTEST, [F.desc("votes"), F.asc("candidate"), *[F.asc(k) for k in extra_keys]])


def second_team_tally(rows: DataFrame) -> DataFrame:
    """Votes per candidate where party labels follow the second team's spelling."""
    known = rows.where(is_in("party_detailed", (*V.COMPARED_PARTIES, "NPA")))
    counted = tally(known, [*COUNTY, "office", "district", "candidate", "party_detailed"], "votes")
    named = counted.withColumn(
        "party_detailed", recode("party_detailed", {"undervote": "UNDERVOTE", "NPA": "NO PARTY AFFILIATION"})
    )
    return rank_in_group(named, CONTEST, [F.desc("votes"), F.asc("candidate")])


def returns_tally(returns: DataFrame, counties: DataFrame, parties: Sequence[str] = V.COMPARED_PARTIES) -> DataFrame:
    """Returns per candidate, ranked before candidates without votes are dropped."""
    ranked = ranked_tally(returns, parties, "votes", relabel=False, extra_keys=("writein", "special"))
    return ranked.where(F.col("votes") > 0).join(counties.select(*COUNTY).distinct(), list(COUNTY), "left_semi")


def align_candidates(h: DataFrame, m: DataFrame, c: DataFrame, v: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """One row per (contest, party, rank) with each source's candidate and votes.

    Stands for: h full-join m, left-join c, full-join v.  A key only c has is
    dropped, and where neither h nor m has the key c's figures are blank.
    """
    stacked = stack_sides(ALIGNED, h=h, m=m, c=c, v=v)
    first_two = F.col("in_h") | F.col("in_m")
    rows = stacked.where(first_two | F.col("in_v")).withColumns(
        {n: F.when(first_two, F.col(n)) for n in ("candidate_c", "votes_c")}
    )
    aligned = rows.select(
        *CONTEST,
        F.col("special_v").alias("special"),
        F.col("writein_v").alias("writein"),
        *[f"{n}_{s}" for s in "hmcv" for n in ("candidate", "votes")],
    )
    return aligned.join(removed.select(*COUNTY), list(COUNTY), "left_anti") if removed is not None else aligned


def classify(
    aligned: DataFrame,
    side: str,
    parties: Sequence[str] = V.MAIN_PARTIES,
    set_by_hand: dict[tuple[str, str], str] = SET_BY_HAND,
) -> DataFrame:
    """Class of each county by how far one source's tallies are off the returns.

    ``candidate_{side}``/``votes_{side}`` against ``candidate_v``/``votes_v``.
    A missing tally counts 0 but is remembered; sums go null when a return is
    missing; a condition that is not known to hold does not hold.
    """
    votes = F.col(f"votes_{side}")
    rows = aligned.where(
        is_in("party_detailed", parties)
        & (F.col("writein").isNull() | (F.col("writein") == 0))
        & (F.col(f"candidate_{side}").isNotNull() | F.col("candidate_v").isNotNull())
    ).withColumns({"__missing": votes.isNull(), "__diff": F.col("votes_v") - F.coalesce(votes, F.lit(0))})
    per_party = rows.groupBy(*COUNTY, "office", "party_detailed").agg(
        strict_sum("__diff").alias("diff"),
        strict_sum("votes_v").alias("votes_v"),
        F.bool_or("__missing").alias("miss"),
    )
    # off the returns by a share; from zero returns any difference is infinitely far
    share = F.when(F.col("votes_v") != 0, F.abs(F.col("diff") / F.col("votes_v"))).when(
        F.col("diff") != 0, F.lit(float("inf"))
    )
    per_party = per_party.withColumn("share", share)
    facts = per_party.groupBy(*COUNTY).agg(
        all_true(F.col("diff") == 0).alias("exact"),
        any_true(F.col("diff") != 0).alias("differs"),
        *[all_true(F.col("share") < t).alias(f"below{k}") for k, t in ((1, 0.01), (5, 0.05), (10, 0.10))],
        *[any_true(F.col("share") >= t).alias(f"reach{k}") for k, t in ((1, 0.01), (5, 0.05))],
        any_true(F.col("share") > 0.10).alias("far"),
        any_true(F.col("miss")).alias("some_miss"),
        any_true(~F.col("miss")).alias("some_have"),
        any_true(~F.col("miss") & F.col("votes_v").isNull()).alias("no_returns"),
    )
    complete = ~F.col("some_miss")
    label = (
        F.when(F.col("exact"), CLASSES[0])
        .when(complete & F.col("below1") & F.col("differs"), CLASSES[1])
        .when(complete & F.col("below5") & F.col("reach1"), CLASSES[2])
        .when(complete & F.col("below10") & F.col("reach5"), CLASSES[3])
        .when(complete & F.col("far"), "red")
        .when(F.col("some_miss") & F.col("some_have"), "candidate missing")
        .when(F.col("some_miss"), "not collected")
        .when(F.col("no_returns"), "no entry in returns")
        .otherwise("unclassified")
    )
    for (state, county), forced in set_by_hand.items():
        label = F.when((F.col("state") == state) & (F.col("county_name") == county), forced).otherwise(label)
    return facts.select(*COUNTY, label.alias(f"color2_{side}"))


def class_rank(side: str = "c") -> Column:
    return ordered_rank(f"color2_{side}", CLASSES)


def release_flag(color: str = "color2_c") -> Column:
    return is_in(color, RELEASABLE).cast("int")


def county_table(
    aligned: DataFrame,
    offices: dict[str, str] = V.OFFICES,
    parties: Sequence[str] = V.MAIN_PARTIES,
    sides: Sequence[str] = ("h", "m", "c"),
) -> DataFrame:
    """One row per county: votes and differences by office, classes, release flag.

    The aligned candidates are read by every class, so they are written once.
    """
    aligned = written_once(aligned, "aligned")
    summed = (
        aligned.where(is_in("party_detailed", parties))
        .groupBy(*COUNTY, "office")
        .agg(*[sum0(f"votes_{s}").alias(f"votes_{s}") for s in (*sides, "v")])
    )
    named = summed.withColumn("office", recode("office", offices))
    measures = {f"votes_{s}": F.first(f"votes_{s}") for s in (*sides, "v")}
    measures |= {f"diff_{s}": F.first(F.col("votes_v") - F.col(f"votes_{s}")) for s in sides}
    wide = to_wide(named, COUNTY, "office", list(offices.values()), measures)
    scored = wide.withColumns(
        {f"match_score_{s}": row_match_rate([f"{o}_diff_{s}" for o in offices.values()], 0) for s in sides if s != "c"}
    )
    for side in sides:
        scored = scored.join(classify(aligned, side, parties), list(COUNTY), "left")
    flagged = scored.withColumn("release", release_flag())
    front = [*COUNTY, *[f"color2_{s}" for s in sides], "release"]
    front += [c for c in flagged.columns if c.startswith("match_")]
    return flagged.select(*front, *[c for c in flagged.columns if c not in front])


def coalesced_comparison(aligned: DataFrame, county: DataFrame) -> DataFrame:
    """Candidate rows of c against v, for counties with any c tally."""
    flagged = aligned.join(county.select(*COUNTY, "release"), list(COUNTY), "left")
    rows = flagged.select(*CONTEST, "release", "candidate_c", "votes_c", "candidate_v", "votes_v")
    kept = keep_group_any(rows, COUNTY, F.col("votes_c").isNotNull())
    share = F.try_divide(F.col("votes_v") - F.col("votes_c"), F.col("votes_v"))
    shown = is_in("party_detailed", (*V.MAIN_PARTIES, "GREEN"))
    return kept.withColumn("diff_pct", F.when(shown, F.format_number(share, 3)))


def traffic_light(
    compared: DataFrame,
    parties: Sequence[str] = V.MAIN_PARTIES,
    near: float = 0.1,
    missing: float = 0.2,
    set_by_hand: dict[tuple[str, str], str] | None = None,
) -> DataFrame:
    """Green, yellow or red per county from candidate rows of c against v.

    A row without a comparison counts as entirely off (share 1).  Green: every
    share 0.  Yellow: shares other than 1 are near and few rows have share 1.
    """
    forced = {("COLORADO", "ARAPAHOE"): "red"} if set_by_hand is None else set_by_hand
    gap = F.abs(F.col("votes_v") - F.col("votes_c"))
    share = F.when(F.col("votes_c") != 0, gap / F.col("votes_c")).when(gap != 0, F.lit(float("inf")))
    rows = compared.where(is_in("party_detailed", parties)).withColumn("__p", F.coalesce(share, F.lit(1.0)))
    off = F.col("__p") == 1
    facts = rows.groupBy(*COUNTY).agg(
        F.bool_and(F.col("__p") == 0).alias("exact"),
        F.bool_and(off | (F.col("__p") < near)).alias("close"),
        F.count_if(off).alias("n_off"),
        F.count(F.lit(1)).alias("n"),
    )
    label = (
        F.when(F.col("exact"), "green")
        .when(F.col("close") & (F.col("n_off") < F.lit(missing) * F.col("n")), "yellow")
        .otherwise("red")
    )
    for (state, county), color in forced.items():
        label = F.when((F.col("state") == state) & (F.col("county_name") == county), color).otherwise(label)
    return facts.select(*COUNTY, label.alias("color"))


def unseen_counties(counties: DataFrame, returns: DataFrame) -> DataFrame:
    """Counties with ballots that the returns do not know (there should be none)."""
    return counties.select(*COUNTY).distinct().join(returns.select(*COUNTY).distinct(), list(COUNTY), "left_anti")


def match_table(county: DataFrame) -> DataFrame:
    """Cross table of exact matches of the two teams, with margins."""
    flags = county.select(
        (F.col("match_score_h") == 1).cast("int").alias("match_h"),
        (F.col("match_score_m") == 1).cast("int").alias("match_m"),
    ).dropna()
    return crosstab_margins(flags, "match_h", "match_m")


def class_table(county: DataFrame, color: str) -> DataFrame:
    return tally(county, [color])


def mismatch_table(county: DataFrame) -> DataFrame:
    """Counties by class and release, as the paper words the classes."""
    # fixed values: wording of the classes in the table
    wording = {
        "0 difference": "0 discrepancy",
        "any < 1% mismatch": "any <1% discrepancy",
        "any < 5% mismatch": "any < 5% discrepancy",
        "any < 10% mismatch": "any < 10% discrepancy",
        "red": "any > 10% discrepancy",
        "no entry in returns": "candidate missing",
    }
    kept = county.where(not_in("state", ("DISTRICT OF COLUMBIA",)) & not_in("county_name", ("ARAPAHOE",)))
    named = kept.withColumn("color2_c", recode("color2_c", wording))
    order = [
        "0 discrepancy", "any <1% discrepancy", "any < 5% discrepancy", "any < 10% discrepancy",
        "any > 10% discrepancy", "candidate missing", "unclassified",
    ]
    return tally(named, ["color2_c", "release"]).withColumn("rank", ordered_rank("color2_c", order))
