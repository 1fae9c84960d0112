"""The paper's tables as DataFrames (rendering stays outside)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.nulls import holds, is_in, lookup, not_in, ratio, recode, sum0
from tallyline.functions.text import comma_number, extract, join_sorted, pad_left, percent_text, title_case
from tallyline.operators.groups import (
    filter_modes, rollup_totals, row_sum, tally, variable_summary, with_group_stats,
)
from tallyline.rules import vocabulary as V

COUNTY = ("state", "county_name")
TWO_PARTIES = ("DEMOCRAT", "REPUBLICAN")


def release_numbers(release: DataFrame, parties: Sequence[str] = (*V.MAIN_PARTIES, "GREEN"), office: str = "US PRESIDENT") -> DataFrame:
    """Records, candidates, voters, counties and states of the release, in one row.

    Rows are folded to distinct (state, county, contest, candidate, party)
    first, so the distinct counts run over a table without the ballots.
    """
    folded = tally(release, [*COUNTY, "office", "district", "candidate", "party_detailed"])
    here = F.col("office") == office
    listed = is_in("party_detailed", parties)
    who = F.struct("office", "district", "candidate", "party_detailed")
    numbers = folded.agg(
        F.sum("n").alias("n_records"),
        F.count_distinct(F.when(listed, who)).alias("n_candidates"),
        F.sum(F.when(here, F.col("n")).otherwise(0)).alias("n_voters"),
        F.count_distinct(F.when(here, F.struct(*COUNTY))).alias("n_counties"),
        F.count_distinct(F.when(here, F.col("state"))).alias("n_states"),
    )
    return numbers.withColumn("n_voters_approx", F.concat(F.format_number(F.col("n_voters") / 1e6, 1), F.lit(" million")))


def coverage(
    release: DataFrame, returns: DataFrame, half: Column | None = None, excluded: Sequence[str] = ("VIRGINIA",)
) -> DataFrame:
    """Share of a state's official votes the release covers, by office.

    A two-seat contest counts half; a share that would print as 0 shows as 1%.
    """
    two_seats = half if half is not None else (F.col("state") == "ARIZONA") & (F.col("office") == "STATE HOUSE")
    weight = F.when(two_seats, F.lit(0.5)).otherwise(F.lit(1.0))
    no_vote = ("UNDERVOTE", "OVERVOTE")
    official = tally(returns.where(not_in("party_simplified", no_vote)), ["state", "office"], "n", "votes")
    official = official.select("state", "office", (F.col("n") * weight).alias("total_voters"))
    counted = tally(release.where(not_in("state", excluded) & not_in("candidate", no_vote)), ["state", "office"])
    counted = counted.withColumn("n", F.col("n") * weight)
    joined = counted.join(official, ["state", "office"], "right")
    share = ratio(F.col("n"), F.col("total_voters"))
    return joined.withColumn("frac_covered", F.when((share > 0) & (share < 0.005), F.lit(0.01)).otherwise(share))


def county_list(release: DataFrame, office: str = "US PRESIDENT") -> DataFrame:
    """Counties with voters, and per state the number of counties and voters."""
    voters = tally(release.where(F.col("office") == office), COUNTY, "voters_pres")
    one_unit = is_in("state", ("RHODE ISLAND", "DELAWARE", "DISTRICT OF COLUMBIA"))
    named = voters.withColumn("county_name", F.when(one_unit, "STATEWIDE").otherwise(F.col("county_name")))
    stats = with_group_stats(named, ["state"], bounded=True, n_counties=F.count(F.lit(1)), __all=F.sum("voters_pres"))
    # fixed values: names title case gets wrong
    spelled = {"Statewide": "(Statewide)", "Mchenry": "McHenry", "Dekalb": "DeKalb", "Mcduffie": "McDuffie"}
    return stats.select(
        title_case("state").alias("state"),
        "county_name",
        recode(title_case("county_name"), spelled).alias("county"),
        "voters_pres",
        "n_counties",
        comma_number("__all").alias("n_voters"),
    )


def county_coverage(
    release: DataFrame, precinct_returns: DataFrame, office: str = "US PRESIDENT",
    candidates: Sequence[str] = ("DONALD J TRUMP", "JOSEPH R BIDEN"), postal: dict[str, str] = V.POSTAL,
    parties: Sequence[str] = TWO_PARTIES,
) -> DataFrame:
    """Counties of the returns with ballot counts, modes, and the map class.

    ``c``: has ballots (or its state is one unit), ``b``: another county of the
    state has, ``a``: none in the state has.
    """
    counted = tally(release.where((F.col("office") == office) & is_in("candidate", candidates)), COUNTY, "cvr_votes")
    counted = counted.withColumn("state_po", lookup("state", postal))
    rows = precinct_returns.where((F.col("office") == office) & is_in("party_simplified", parties))
    # folded to modes first: the rule and the list need one row per county and mode
    modes = rows.groupBy("state_po", "county_name", "county_fips", "mode").agg(sum0("votes").alias("votes"))
    kept = filter_modes(modes, ["state_po", "county_name"], "total_only", bounded=True)
    counties = kept.groupBy("state_po", "county_name", "county_fips").agg(
        F.sum("votes").alias("prec_votes"), join_sorted(F.collect_set("mode"), ";").alias("modes")
    )
    joined = counties.withColumn("county_fips", pad_left("county_fips", 5)).join(
        counted, ["state_po", "county_name"], "left"
    )
    has = F.col("cvr_votes").isNotNull()
    flagged = with_group_stats(joined, ["state_po"], bounded=True, __any=F.bool_or(has))
    covered = F.when(has | is_in("state_po", ("DE", "RI")), "c").when(F.col("__any"), "b").otherwise("a")
    return flagged.select(
        "state", "state_po", "county_name", "modes", "county_fips", "cvr_votes", "prec_votes", covered.alias("covered")
    )


def _tilt_measures(dem: Column, rep: Column, lib: Column, party: Column, votes: Column) -> dict[str, Column]:
    def total(*labels: Column) -> Column:
        member = F.coalesce(party.isin(*labels), F.lit(False))
        return F.sum(F.when(member, votes).otherwise(0))

    return {"dem_prez": ratio(total(dem), total(dem, rep)), "n_voters": total(dem, rep, lib)}


def tilt(rows: DataFrame, label: str, votes: str | None = None, parties: Sequence[str] = V.MAIN_PARTIES) -> DataFrame:
    """Two-party share and voters by state, plus a labelled total over all rows.

    Rows are folded to (state, county, party) before the rollup doubles them.
    """
    folded = tally(rows, [*COUNTY, "party_detailed"], "__v", votes)
    dem, rep, lib = (F.lit(p) for p in parties)
    measures = _tilt_measures(dem, rep, lib, F.col("party_detailed"), F.col("__v"))
    return rollup_totals(folded, "state", label, **measures, n_counties=F.count_distinct("county_name"))


def state_tilt(
    release: DataFrame, returns: DataFrame, label: str, national: str = "All 50 States",
    office: str = "US PRESIDENT", parties: Sequence[str] = V.MAIN_PARTIES,
) -> DataFrame:
    """Ballots against the population, by state, over our states and over all.

    ``label`` names the total over our states; address totals by ``is_total``.
    """
    cvr = tilt(release.where(F.col("office") == office), label, None, parties).drop("n_counties")
    official = returns.where(F.col("office") == office)
    ours = official.join(release.where(F.col("office") == office).select("state").distinct(), "state", "left_semi")
    by_state = tilt(ours, label, "votes", parties)
    everywhere = tilt(official.where(not_in("state", ("DISTRICT OF COLUMBIA",))), national, "votes", parties)
    population = by_state.unionByName(everywhere.where(F.col("is_total") == 1)).drop("n_counties", "is_total")
    row = cvr.sparkSession.createDataFrame([(national,)], "state string")
    ballots = cvr.unionByName(row, allowMissingColumns=True)
    joined = ballots.select(
        "state", "is_total", F.col("dem_prez").alias("dem_cvr"), F.col("n_voters").alias("voters_cvr")
    ).join(
        population.select("state", F.col("dem_prez").alias("dem_pop"), F.col("n_voters").alias("voters_pop")),
        "state", "left",
    )
    return joined.withColumns(
        {
            "state": title_case("state"),
            "diff_prez": F.col("dem_cvr") - F.col("dem_pop"),
            "pct_voters": percent_text(ratio(F.col("voters_cvr"), F.col("voters_pop"))),
        }
    )


def grand_total(table: DataFrame, measure: str) -> DataFrame:
    """The total's figure, found by its marker rather than its position."""
    return table.where(F.col("is_total") == 1).select(measure)


# fixed values: census variables and the figures made of them
CENSUS_NAMES = {
    "P1_001N": "tot", "P2_001N": "tot_urb_rur", "P2_002N": "tot_urb", "H4_001N": "tot_own",
    "H4_002N": "tot_own_mort", "H4_003N": "tot_own_free", "P12_001N": "tot_age", "P3_001N": "tot_races",
    "P3_002N": "white", "P3_003N": "black", "P4_001N": "hisp_og_tot", "P4_003N": "hisp_og",
}
UNDER_18 = ("P12_003N", "P12_004N", "P12_005N", "P12_006N", "P12_027N", "P12_028N", "P12_029N", "P12_030N")
OVER_65 = (
    "P12_020N", "P12_021N", "P12_022N", "P12_023N", "P12_024N", "P12_025N",
    "P12_044N", "P12_045N", "P12_046N", "P12_047N", "P12_048N", "P12_049N",
)
CENSUS_FIGURES = {
    "prop_white": "Percent White", "prop_black": "Percent Black", "prop_hisp": "Percent Hispanic",
    "prop_u18": "Percent Under 18", "prop_o65": "Percent Over 65", "prop_urb": "Percent Urban",
    "prop_own_occ": "Percent Homeowning",
}
# fixed values: counties of states whose ballots come as one unit
ONE_UNIT_COUNTIES = (
    ("DELAWARE", "KENT", "10001"), ("DELAWARE", "NEW CASTLE", "10003"), ("DELAWARE", "SUSSEX", "10005"),
    ("RHODE ISLAND", "BRISTOL", "44001"), ("RHODE ISLAND", "KENT", "44003"), ("RHODE ISLAND", "NEWPORT", "44005"),
    ("RHODE ISLAND", "PROVIDENCE", "44007"), ("RHODE ISLAND", "WASHINGTON", "44009"),
)


def census_figures(census: DataFrame) -> DataFrame:
    """Wide census counts -> percentages per county (missing cells count 0 in sums).

    The owner share divides by population, as published.
    """
    named = census.withColumnsRenamed({k: v for k, v in CENSUS_NAMES.items() if k in census.columns})

    def percent(part: Column, whole: str) -> Column:
        return ratio(part, F.col(whole)) * 100

    figures = named.withColumns(
        {
            "prop_urb": percent(F.col("tot_urb"), "tot_urb_rur"),
            "prop_white": percent(F.col("white"), "tot_races"),
            "prop_black": percent(F.col("black"), "tot_races"),
            "prop_hisp": percent(F.col("hisp_og"), "hisp_og_tot"),
            "own_occupy": row_sum("tot_own_mort", "tot_own_free"),
            "prop_own_occ": percent(row_sum("tot_own_mort", "tot_own_free"), "tot"),
            "all18": row_sum(*UNDER_18),
            "all65": row_sum(*OVER_65),
            "prop_u18": percent(row_sum(*UNDER_18), "tot_age"),
            "prop_o65": percent(row_sum(*OVER_65), "tot_age"),
            "county": F.upper(F.trim(extract("NAME", r".*(?= County)"))),
            "state": F.trim(extract("NAME", r"(?<=, ).*")),
        }
    )
    return figures.drop(*[c for c in figures.columns if c.startswith("P1")])


def county_codes(codes: DataFrame) -> DataFrame:
    """(state_name, county, state_code, county_code) -> joinable (state, county_name, county_fips)."""
    county = F.upper(F.regexp_replace("county", " County$", ""))
    return codes.select(
        F.upper("state_name").alias("state"),
        F.regexp_replace(county, r"^ST\.", "ST").alias("county_name"),
        pad_left(F.concat("state_code", "county_code"), 5).alias("county_fips"),
    )


def census_comparison(release: DataFrame, codes: DataFrame, census: DataFrame) -> DataFrame:
    """Our counties against all counties: weighted mean, mean, median, deviation."""
    ours = release.select(*COUNTY).distinct().join(codes, list(COUNTY))
    units = ours.sparkSession.createDataFrame(list(ONE_UNIT_COUNTIES), "state string, county_name string, county_fips string")
    listed = ours.unionByName(units).where(F.col("county_name") != "STATEWIDE").drop("state")
    joined = listed.join(census.withColumnRenamed("GEOID", "county_fips"), "county_fips", "left")
    names = list(CENSUS_FIGURES)
    subset, national = variable_summary(joined, names, "tot"), variable_summary(census, names, "tot")
    both = subset.withColumnsRenamed({c: f"{c}_OurData" for c in subset.columns if c != "Variable"}).join(
        national.withColumnsRenamed({c: f"{c}_National" for c in national.columns if c != "Variable"}), "Variable", "left"
    )
    return both.withColumn("Variable", recode("Variable", CENSUS_FIGURES))


def district_differences(compared: DataFrame, least: int = 150, parties: Sequence[str] = TWO_PARTIES) -> DataFrame:
    """Ballots against returns by contest, for contests with enough votes.

    The share is only known where both sides have votes.
    """
    summed = (
        compared.where(is_in("party_detailed", parties))
        .groupBy("state", "office", "county_name", "district", "release")
        .agg(sum0("votes_c").alias("cvr_votes"), sum0("votes_v").alias("total_votes"))
    )
    diff = F.col("cvr_votes") - F.col("total_votes")
    share = F.when((F.col("total_votes") != 0) & (F.col("cvr_votes") != 0), ratio(diff, F.col("total_votes")))
    return summed.withColumns({"diff": diff, "perc_diff": share}).where(F.col("total_votes") >= least)


def precinct_comparison(
    coalesced: DataFrame, returns: DataFrame, counties: DataFrame, office: str = "US PRESIDENT",
    parties: Sequence[str] = TWO_PARTIES, precinct: str = "precinct_returns",
) -> DataFrame:
    """Votes per precinct and party in ballots and returns.

    Precincts listed both in total and by mode are left out; redacted returns
    (below zero) too.
    """
    ours = coalesced.join(counties.select(*COUNTY), list(COUNTY), "left_semi").where(
        (F.col("office") == office) & is_in("party_detailed", parties)
    )
    ballots = tally(ours, [*COUNTY, precinct, "party_detailed"], "n_cvr").withColumnRenamed(precinct, "precinct")
    inner = extract("precinct", r"(?<=\d{5}).+?(?=\_)")
    odd = holds((F.col("county_name") == "HUMBOLDT") & (F.col("state") == "CALIFORNIA"))
    official = returns.where((F.col("office") == office) & is_in("party_detailed", parties)).withColumn(
        "precinct", F.when(odd, inner).otherwise(F.col("precinct"))
    )
    keys = [*COUNTY, "precinct", "party_detailed"]
    # one row per precinct and mode is enough for the rule
    by_mode = tally(official, [*keys, "mode"], "votes", "votes")
    single = tally(filter_modes(by_mode, keys, "drop_mixed", bounded=True), keys, "n_v", "votes")
    # both sides were just folded by these keys
    joined = ballots.join(single, keys, "left")
    # fixed values: labels of the figure
    shown = {"REPUBLICAN": "Trump Votes", "DEMOCRAT": "Biden Votes"}
    named = joined.where(F.col("precinct").isNotNull()).withColumn("cand", lookup("party_detailed", shown))
    return named.where(F.col("n_v") > -1)


def precinct_numbers(compared: DataFrame, near: int = 3) -> DataFrame:
    """Precincts validated, exact, and within a few votes; counties with any."""
    place = F.struct(*COUNTY, "precinct")
    known = compared.where(F.col("n_v").isNotNull())
    close = F.col("n_cvr").between(F.col("n_v") - near, F.col("n_v") + near)
    flags = known.groupBy(*COUNTY, "precinct").agg(
        F.bool_or(F.col("n_cvr") == F.col("n_v")).alias("exact"), F.bool_or(close).alias("close")
    )
    return flags.agg(
        F.count(place).alias("n_precincts"),
        F.count_distinct(F.struct(*COUNTY)).alias("n_counties"),
        F.count_if("exact").alias("n_exact"),
        F.count_if("close").alias("n_within"),
    )
