"""The paper's tables on literal inputs."""

import pytest
from pyspark.sql import functions as F

from tallyline.plans import reports as R


def cells(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


REL = "state string, county_name string, cvr_id long, office string, district string, candidate string, party_detailed string"


def release(spark, *rows):
    return spark.createDataFrame([("S1", "A", k, *r) if len(r) == 4 else r for k, r in enumerate(rows)], REL)


P = ("US PRESIDENT", "FEDERAL")


def test_release_numbers(spark):
    df = release(spark, (*P, "ANN", "DEMOCRAT"), (*P, "ANN", "DEMOCRAT"), (*P, "X", "WHIG"), ("US HOUSE", "1", "BOB", "GREEN"),
                 ("S2", "B", 9, *P, "ANN", "DEMOCRAT"), ("S2", "C", 9, "US HOUSE", "2", "BOB", "GREEN"))
    assert R.release_numbers(df).head().asDict() == {
        "n_records": 6, "n_candidates": 3, "n_voters": 4, "n_counties": 2, "n_states": 2, "n_voters_approx": "0.0 million"}


def test_coverage_halves_and_floors(spark):
    returns = spark.createDataFrame(
        [("ARIZONA", "STATE HOUSE", "D", 200), ("OHIO", "GOVERNOR", "D", 1000), ("OHIO", "GOVERNOR", "UNDERVOTE", 5000), ("IOWA", "GOVERNOR", "D", 10)],
        "state string, office string, party_simplified string, votes long")
    rows = [("ARIZONA", "A", k, "STATE HOUSE", "1", "X", "D") for k in range(50)] + [("OHIO", "A", 1, "GOVERNOR", "1", "X", "D"), ("OHIO", "A", 2, "GOVERNOR", "1", "UNDERVOTE", None)]
    got = R.coverage(release(spark, *rows), returns)
    assert cells(got, "state", "n", "total_voters", "frac_covered") == [("ARIZONA", 25.0, 100.0, 0.25), ("IOWA", None, 10.0, None), ("OHIO", 1.0, 1000.0, 0.01)]


def test_county_list(spark):
    df = release(spark, ("ILLINOIS", "MCHENRY", 1, *P, "x", "D"), ("ILLINOIS", "DEKALB", 2, *P, "x", "D"), ("DELAWARE", "KENT", 1, *P, "x", "D"))
    assert cells(R.county_list(df), "state", "county", "n_counties", "n_voters") == [
        ("Delaware", "(Statewide)", 1, "1"), ("Illinois", "DeKalb", 2, "2"), ("Illinois", "McHenry", 2, "2")]


def test_county_coverage_classes(spark):
    df = release(spark, ("OHIO", "WAYNE", 1, *P, "DONALD J TRUMP", "REPUBLICAN"), ("OHIO", "WAYNE", 2, *P, "JO JORGENSEN", "LIBERTARIAN"))
    rows = [("OH", "WAYNE", "1", "TOTAL", 5), ("OH", "WAYNE", "1", "MAIL", 2), ("OH", "ADAMS", "39001", "MAIL", 3), ("OH", "ADAMS", "39001", "DAY", 4), ("IA", "ADAIR", "2", "DAY", 1), ("RI", "KENT", "3", "DAY", 1)]
    returns = spark.createDataFrame([(s, c, f, P[0], "DEMOCRAT", m, v) for s, c, f, m, v in rows],
                                    "state_po string, county_name string, county_fips string, office string, party_simplified string, mode string, votes int")
    assert cells(R.county_coverage(df, returns), "county_name", "modes", "county_fips", "cvr_votes", "prec_votes", "covered") == [
        ("ADAIR", "DAY", "00002", None, 1, "a"), ("ADAMS", "DAY;MAIL", "39001", None, 7, "b"), ("KENT", "DAY", "00003", None, 1, "c"), ("WAYNE", "TOTAL", "00001", 1, 5, "c")]


def test_state_tilt(spark):
    df = release(spark, ("OHIO", "A", 1, *P, "x", "DEMOCRAT"), ("OHIO", "A", 2, *P, "x", "REPUBLICAN"), ("IOWA", "B", 1, *P, "x", "DEMOCRAT"), ("IOWA", "B", 2, *P, "x", "GREEN"))
    returns = spark.createDataFrame([(s, "A", P[0], p, v) for s, p, v in (("OHIO", "DEMOCRAT", 30), ("OHIO", "REPUBLICAN", 70), ("IOWA", "DEMOCRAT", 10), ("UTAH", "REPUBLICAN", 90))],
                                    "state string, county_name string, office string, party_detailed string, votes long")
    got = R.state_tilt(df, returns, "All 2 states")
    assert cells(got, "state", "dem_cvr", "voters_cvr", "dem_pop", "voters_pop", "pct_voters") == [
        ("All 2 States", pytest.approx(2 / 3), 3, pytest.approx(40 / 110), 110, "3"), ("All 50 States", None, None, 0.2, 200, None),
        ("Iowa", 1.0, 1, 1.0, 10, "10"), ("Ohio", 0.5, 2, 0.3, 100, "2")]
    assert R.grand_total(R.tilt(df, "All"), "dem_prez").head()[0] == pytest.approx(2 / 3)


def census(spark, *counties):
    names = ["GEOID", "NAME", *R.CENSUS_NAMES, *R.UNDER_18, *R.OVER_65]
    rows = [(g, n, *[float(pop)] * len(R.CENSUS_NAMES), *[1.0] * 8, *[None] * 12) for g, n, pop in counties]
    return R.census_figures(spark.createDataFrame(rows, ", ".join(f"{n} {'string' if n in ('GEOID', 'NAME') else 'double'}" for n in dict.fromkeys(names))))


def test_census_figures_and_comparison(spark):
    table = census(spark, ("39001", "Adams County, Ohio", 100), ("39003", " St. Mary County, Ohio", 50), ("10001", "Kent County, Delaware", 200))
    row = {r["GEOID"]: r for r in table.collect()}["39001"]
    assert (row["county"], row["state"], row["prop_urb"], row["prop_u18"], row["prop_o65"], row["prop_own_occ"]) == ("ADAMS", "Ohio", 100.0, 8.0, 0.0, 200.0)
    codes = R.county_codes(spark.createDataFrame([("Ohio", "St. Mary County", "39", "003"), ("Ohio", "Adams County", "39", "1")],
                                                 "state_name string, county string, state_code string, county_code string"))
    assert cells(codes) == [("OHIO", "ADAMS", "00391"), ("OHIO", "ST MARY", "39003")]
    ours = R.census_comparison(spark.createDataFrame([("OHIO", "ST MARY", 1)], "state string, county_name string, cvr_id int"), codes, table)
    u18 = {r["Variable"]: r for r in ours.collect()}["Percent Under 18"]
    assert u18["Mean_OurData"] == pytest.approx((16 + 4) / 2) and u18["Median_National"] == 8.0
    assert u18["Total_National"] == pytest.approx((8 * 100 + 16 * 50 + 4 * 200) / 350)


def test_district_differences(spark):
    rows = [("S", "C", "O", "1", "DEMOCRAT", 1, 100, 160), ("S", "C", "O", "1", "REPUBLICAN", 1, 60, 40), ("S", "C", "O", "2", "DEMOCRAT", 1, None, 150), ("S", "C", "O", "3", "DEMOCRAT", 1, 5, 149)]
    df = spark.createDataFrame(rows, "state string, county_name string, office string, district string, party_detailed string, release int, votes_c long, votes_v long")
    assert cells(R.district_differences(df), "district", "cvr_votes", "total_votes", "diff", "perc_diff") == [("1", 160, 200, -40, -0.2), ("2", 0, 150, -150, None)]


def test_precinct_comparison_and_numbers(spark):
    coalesced = spark.createDataFrame(
        [("S", "C", P[0], "DEMOCRAT", pr) for pr in ("a", "a", "b", "c", "d", None)] + [("S", "other", P[0], "DEMOCRAT", "a")],
        "state string, county_name string, office string, party_detailed string, precinct_returns string")
    rows = [("a", "DAY", 1), ("a", "MAIL", 1), ("b", "TOTAL", 9), ("b", "MAIL", 9), ("c", "DAY", 4), ("d", "DAY", -1)]
    returns = spark.createDataFrame([("S", "C", P[0], "DEMOCRAT", *r) for r in rows],
                                    "state string, county_name string, office string, party_detailed string, precinct string, mode string, votes long")
    counties = spark.createDataFrame([("S", "C")], "state string, county_name string")
    got = R.precinct_comparison(coalesced, returns, counties)
    assert cells(got, "precinct", "n_cvr", "n_v", "cand") == [("a", 2, 2, "Biden Votes"), ("c", 1, 4, "Biden Votes")]
    assert R.precinct_numbers(got).head().asDict() == {"n_precincts": 2, "n_counties": 1, "n_exact": 1, "n_within": 2}
