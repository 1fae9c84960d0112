"""Release formatting, team merge, redaction, checks; second team; returns."""

import pytest
from pyspark.sql import functions as F

from tallyline.plans import release as L
from tallyline.plans import returns as O
from tallyline.plans import second_team as S2
from tallyline.sources.layout import read_partitioned


def cells(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


CHOICE = "state string, county_name string, cvr_id long, precinct string, jurisdiction_name string, office string, district string, candidate string, party_detailed string, magnitude int"


def choice(state="S", county="C", cvr_id=1, precinct="p", office="GOVERNOR", district="1", candidate="A", party="DEMOCRAT", magnitude=None):
    return (state, county, cvr_id, precinct, county, office, district, candidate, party, magnitude)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), CHOICE)


@pytest.mark.parametrize("candidate, party, expected", [
    ("WRITE-IN", "DEMOCRAT", ("WRITEIN", "WRITEIN", None)),
    ("Ann", "W-I", ("Ann", "WRITEIN", None)),
    ("WRITEIN", None, ("WRITEIN", "WRITEIN", None)),
    ("NO SELECTION", None, ("UNDERVOTE", None, None)),
    ("OVERVOTE", "DEMOCRAT", ("OVERVOTE", "DEMOCRAT", None)),
    ("Ann", "LIBERTARIAN", ("Ann", "LIBERTARIAN", "LBT")),
    ("Ann", "GREEN", ("Ann", "GREEN", "GRN")),
    ("Ann", "WHIG", ("Ann", "WHIG", "OTH")),
    ("Ann", None, ("Ann", None, "OTH")),
])
def test_release_labels(spark, candidate, party, expected):
    got = L.format_release(table(spark, choice(candidate=candidate, party=party)))
    assert cells(got, "candidate", "party_detailed", "party") == [expected]
    assert "jurisdiction_name" not in got.columns
    assert got.columns.index("party") == got.columns.index("party_detailed") - 1


def test_dropped_candidates_need_all_conditions(spark):
    bad = choice("UTAH", "SAN JUAN", candidate="KANYE WEST", party=None)
    kept = [choice("UTAH", "SAN JUAN", 2, candidate="KANYE WEST", party="X"), choice(None, "SAN JUAN", 3, candidate="KANYE WEST", party=None)]
    assert cells(L.format_release(table(spark, bad, *kept)), "cvr_id") == [(2,), (3,)]


@pytest.mark.parametrize("state, office, magnitude, expected", [
    ("OHIO", "STATE HOUSE", None, 1), ("OHIO", "STATE HOUSE", -1, 1), ("OHIO", "STATE HOUSE", 3, 3),
    ("ARIZONA", "STATE HOUSE", None, 2), ("ARIZONA", "GOVERNOR", -1, 1), ("WEST VIRGINIA", "STATE HOUSE", -1, -1),
    ("WEST VIRGINIA", "STATE HOUSE", None, None),
])
def test_magnitude(spark, state, office, magnitude, expected):
    assert L.fill_magnitude(table(spark, choice(state, office=office, magnitude=magnitude))).head()["magnitude"] == expected


@pytest.mark.parametrize("state, county, precinct, expected", [
    ("WISCONSIN", "BROWN", "Village of Pulaski W4, 7", "PULASKI"), ("WISCONSIN", "BROWN", None, "BROWN"),
    ("OHIO", "BROWN", "Village of Pulaski W4, 7", "BROWN"), ("WISCONSIN", "DANE", "V Cambridge Wd 1", "JEFFERSON"),
    ("WISCONSIN", "PIERCE", "City of River Falls, Wards 1-4,15", "ST CROIX"),
])
def test_moved_precincts(spark, state, county, precinct, expected):
    row = L.reallocate_precincts(table(spark, choice(state, county, precinct=precinct))).head()
    assert row["county_name"] == expected
    assert row["jurisdiction_name"] == (expected if state == "WISCONSIN" else county)


def test_teams_to_release_end_to_end(spark, tmp_path):
    first = table(
        spark,
        choice("OHIO", "WAYNE", 1, "a", candidate="ANN", party=None), choice("OHIO", "WAYNE", 2, "b", candidate="UNDERVOTE", party=None),
        choice("OHIO", "MONROE", 1), choice("TEXAS", "TRAVIS", 1),
        choice("OHIO", "SENECA", 1, office="STATE HOUSE", district="087"), choice("OHIO", "SENECA", 1, office="STATE HOUSE", district="088"),
        choice("OHIO", "SENECA", 2, office="STATE HOUSE", district="087"),
    )
    second = table(spark, choice("TEXAS", "TRAVIS", 7, "t", candidate="WRITE-IN"), choice("OHIO", "WAYNE", 9)).drop("jurisdiction_name")
    pair = "state string, county_name string"
    removed = spark.createDataFrame([("OHIO", "MONROE"), ("VIRGINIA", "")], pair)
    swapped = spark.createDataFrame([("TEXAS", "TRAVIS")], pair)
    missing = spark.createDataFrame([("OHIO", "GOVERNOR", "ANN", "1", "REPUBLICAN")], "state string, office string, candidate string, district string, party_detailed string")
    precincts = spark.createDataFrame([("OHIO", "WAYNE", "a", "a-cvr", "a-ret")], "state string, county_name string, precinct string, precinct_cvr string, precinct_returns string")
    both = L.coalesce_teams(first, second, removed, swapped, missing, precincts)
    assert cells(both, "county_name", "cvr_id", "district", "candidate", "party", "magnitude", "precinct_returns") == sorted([
        ("WAYNE", 1, "1", "ANN", "REP", 1, "a-ret"), ("WAYNE", 2, "1", "UNDERVOTE", None, 1, None),
        ("TRAVIS", 7, "1", "WRITEIN", None, 1, None), ("SENECA", 1, "088", "A", "DEM", 1, None), ("SENECA", 2, "087", "A", "DEM", 1, None),
    ], key=str)
    county = spark.createDataFrame([("OHIO", "WAYNE", 1), ("OHIO", "SENECA", 0), ("TEXAS", "TRAVIS", 1)], pair + ", release int")
    groups = spark.createDataFrame([("OHIO", "WAYNE", "1", "a-cvr", "a-ret", "small", "small r", "st")] * 2,
                                   pair + ", cvr_id string, precinct_cvr string, precinct_returns string, precinct_cvr_group string, precinct_returns_group string, style string")
    released = L.subset_release(both, county, groups)
    assert "precinct" not in released.columns and "style" not in released.columns
    assert cells(released, "county_name", "cvr_id", "precinct_cvr", "precinct_returns") == sorted(
        [("WAYNE", 1, "small", "small r"), ("WAYNE", 2, None, None), ("TRAVIS", 7, None, None)], key=str)
    path = str(tmp_path / "release")
    L.write_release(released, path)
    stored = read_partitioned(spark, path)
    L.check_release(stored)
    assert cells(L.released_counties(stored)) == [("OHIO", "WAYNE"), ("TEXAS", "TRAVIS")]
    assert cells(L.party_frequency(stored)) == [("REP", 1), (None, 2)]


def test_release_check_finds_repeats(spark):
    twice = [choice(cvr_id=1), choice(cvr_id=1, candidate="B")]
    with pytest.raises(L.RepeatedBallots, match="GOVERNOR: 2"):
        L.check_release(table(spark, *twice))
    fine = [choice("ARIZONA", office="STATE HOUSE"), choice("ARIZONA", office="STATE HOUSE", candidate="B"),
            choice("GEORGIA", office="US SENATE", district="GEORGIA"), choice("GEORGIA", office="US SENATE", district="GEORGIA-III")]
    L.check_release(table(spark, *fine))
    # every voter twice has a single distinct count, yet is no clean release
    assert cells(L.repeated_ballots(table(spark, *twice), "GOVERNOR")) == [(2, 1)]


def test_publish_counts_voters_and_refuses_repeats(spark, tmp_path):
    path = str(tmp_path / "published")
    fine = [choice(cvr_id=k) for k in range(5)] + [choice(cvr_id=1, office="SHERIFF")] * 2 + [choice(None, cvr_id=1)]
    fine += [choice("ARIZONA", office="STATE HOUSE"), choice("ARIZONA", office="STATE HOUSE", candidate="B"), choice(cvr_id=None, office=None),
             choice("GEORGIA", office="US SENATE", district="GEORGIA"), choice("GEORGIA", office="US SENATE", district="GEORGIA-III")]
    seen = L.publish_release(table(spark, *fine), path)
    assert {k: n for k, n in seen.items() if n} == {"GOVERNOR": 6, "US SENATE": 2}
    stored = cells(read_partitioned(spark, path), *["state", "cvr_id", "office", "candidate"])
    assert len(stored) == len(fine)
    # a refused release leaves everything as it was, good counties of it included
    for bad, why in [((choice(cvr_id=9), choice(cvr_id=9, candidate="B")), "GOVERNOR: 2 times"),
                     ((choice(cvr_id=None, office="US HOUSE"),), "US HOUSE: no voter number")]:
        with pytest.raises(L.RepeatedBallots, match=why):
            L.publish_release(table(spark, choice("ARIZONA", cvr_id=5), choice("NEW", cvr_id=1), *bad), path)
        assert cells(read_partitioned(spark, path), "state", "cvr_id", "office", "candidate") == stored
    # only the counties of a release are replaced
    L.publish_release(table(spark, choice("ARIZONA", cvr_id=5)), path)
    assert len(cells(read_partitioned(spark, path), "cvr_id")) == len(fine) - 1
    assert set(L.publish_release(table(spark, choice()).limit(0), path).values()) == {0}


def test_one_to_one_fixes_fill_party(spark):
    rows = table(spark, choice("OHIO", office="STATE HOUSE", district="053", candidate="THOMAS HELL", party=None), choice("MICHIGAN", "MASON", district="103"))
    meta = spark.createDataFrame([("OHIO", "STATE HOUSE", "THOMAS HALL", "053", "REPUBLICAN")], "state string, office string, candidate string, district string, party_detailed string")
    assert cells(L.add_party(rows, meta), "district", "candidate", "party_detailed") == [("053", "THOMAS HALL", "REPUBLICAN"), ("101", "A", "DEMOCRAT")]


# ------------------------------------------------------------ second team

ITEM = "state string, county string, cvr_id long, item string, party string"


def test_voter_labels(spark):
    p = "US_PRES"
    rows = [("S", "C", 1, p, "DEM"), ("S", "C", 1, "US_REP", "DEM"), ("S", "C", 2, p, "REP"), ("S", "C", 2, "US_REP", "DEM"),
            ("S", "C", 3, p, "LBT"), ("S", "C", 3, "US_REP", "REP"), ("S", "C", 4, "US_REP", "GRN"), ("S", "C", 5, p, "DEM"), ("S", "C", 5, "US_REP", None)]
    got = S2.voter_labels(spark.createDataFrame(rows, ITEM))
    assert cells(got, "cvr_id", "pres", "pid") == [(1, "D", "DEM"), (2, "R", "SPL"), (3, "LBT", "REP"), (4, None, None), (5, "D", None)]


def test_split_records_and_repeats(spark):
    records = spark.createDataFrame([(1, 1, "a", "x"), (2, 2, "b", "y"), (3, 1, "c", "z"), (3, 1, "c", "w"), (4, 1, "d", None)],
                                    "cvr_id long, column int, item string, choice string")
    info = spark.createDataFrame([(1, 1), (2, 1), (3, None), (4, None)], "cvr_id long, cvr_id_merged long")
    assert cells(S2.drop_repeated(records, info), "cvr_id", "column", "item") == [(1, 1, "a"), (1, 2, "b")]


@pytest.mark.parametrize("state, item, dist, choice_text, party, expected", [
    ("GA", "US_SEN (S)", "3", "Loeffler", "REP?", ("GEORGIA", "US SENATE", "GEORGIA-III", "LOEFFLER", "REPUBLICAN")),
    ("AK", "US_REP", "1", "x", "LIB", ("ALASKA", "US HOUSE", "000", "X", "LIBERTARIAN")),
    ("CA", "ST_REP", "7", "UNDERVOTE?", "", ("CALIFORNIA", "STATE HOUSE", "007", "UNDERVOTE?", "undervote")),
    ("CA", "US_PRES", "7", "NA", "LIB", ("CALIFORNIA", "US PRESIDENT", "FEDERAL", "NA", "LIB")),
    ("ZZ", "ST_GOV", "1", "x", "GRE", (None, "GOVERNOR", "001", "X", "GREEN")),
])
def test_common_format(spark, state, item, dist, choice_text, party, expected):
    row = (state, "San_Mateo", 1, item, choice_text, dist, party, 1)
    df = spark.createDataFrame([row], "state string, county string, cvr_id long, item string, choice string, dist string, party string, num_votes int")
    got = S2.to_common(df)
    assert cells(got, "state", "office", "district", "candidate", "party_detailed") == [expected]
    assert got.head()["county_name"] == "SAN MATEO" and got.head()["magnitude"] == 1


def test_county_spellings(spark):
    df = spark.createDataFrame([("GA", "Bleckly", "US_PRES", "x", "1", "DEM", 1)], "state string, county string, item string, choice string, dist string, party string, num_votes int")
    assert S2.to_common(df).head()["county_name"] == "BLECKLEY"


# ------------------------------------------------------------ returns

RAW = ("state string, county_name string, county_fips string, jurisdiction_name string, jurisdiction_fips string, precinct string, mode string, "
       "office string, district string, magnitude int, special boolean, writein boolean, party_detailed string, party_simplified string, candidate string, votes long")


def raw(state="OHIO", county="WAYNE", precinct="p", mode="DAY", office="GOVERNOR", district="1", special=False, party="DEMOCRAT", simplified="DEMOCRAT", candidate="A", votes=1):
    return (state, county, "1", county, "9", precinct, mode, office, district, 1, special, False, party, simplified, candidate, votes)


def standard(spark, *rows):
    return O.standardise(spark.createDataFrame(list(rows), RAW))


def test_returns_labels(spark):
    got = standard(
        spark, raw(), raw("ALASKA", office="STATE SENATE", district="A"), raw(office="US PRESIDENT"), raw("GEORGIA", office="US SENATE", special=True),
        raw("TEXAS", "COLLIN", precinct="12", office="US HOUSE"), raw(office="SHERIFF"), raw(candidate="UNDERVOTES", party=None),
        raw("MINNESOTA", party="DEMOCRATIC FARMER LABOR"), raw("FLORIDA", office="US HOUSE", district="018", candidate="K W MILLER", party=None),
    )
    rows = cells(got, "state", "county_name", "jurisdiction_name", "precinct", "office", "district", "party_detailed")
    assert rows == sorted([
        ("OHIO", "WAYNE", "WAYNE", "p", "GOVERNOR", "OHIO", "DEMOCRAT"), ("ALASKA", "STATEWIDE", None, "p", "STATE SENATE", "00A", "DEMOCRAT"),
        ("OHIO", "WAYNE", "WAYNE", "p", "US PRESIDENT", "FEDERAL", "DEMOCRAT"), ("GEORGIA", "WAYNE", "WAYNE", "p", "US SENATE", "GEORGIA-III", "DEMOCRAT"),
        ("TEXAS", "COLLIN", "COLLIN", "0000012", "US HOUSE", "001", "DEMOCRAT"), ("OHIO", "WAYNE", "WAYNE", "p", "GOVERNOR", "OHIO", "UNDERVOTE"),
        ("MINNESOTA", "WAYNE", "WAYNE", "p", "GOVERNOR", "MINNESOTA", "DEMOCRAT"), ("FLORIDA", "WAYNE", "WAYNE", "p", "US HOUSE", "018", "NO PARTY AFFILIATION"),
    ], key=str)


def test_single_correction_touches_only_its_row(spark):
    got = standard(spark, raw("GEORGIA", candidate="ALLEN BUCKLEY", party="X", simplified="X"), raw("GEORGIA", party="WHIG", simplified="OTHER"))
    assert cells(got, "candidate", "party_detailed", "party_simplified") == [("A", "WHIG", "OTHER"), ("ALLEN BUCKLEY", "INDEPENDENT", "OTHER")]


def test_totals_replace_parts_and_external_counts_win(spark):
    rows = standard(spark, raw(mode="TOTAL", votes=9), raw(mode="MAIL", votes=4), raw(precinct="q", mode="MAIL", votes=2), raw("NEVADA", "NYE", candidate="GREG HAFEN", party="REPUBLICAN", votes=1))
    external = spark.createDataFrame([("OHIO", "WAYNE", "1", "GOVERNOR", "OHIO", "A", 77)], "state string, county_name string, county_fips string, office string, district string, candidate string, candidatevotes long")
    by_mode, by_county = O.county_totals(rows, external)
    assert cells(by_mode, "mode", "votes") == [("DAY", 1), ("MAIL", 2), ("TOTAL", 9)]
    assert cells(by_county, "state", "votes") == [("FLORIDA", 66892), ("NEVADA", 19852), ("OHIO", 77)]


def test_assemble_swaps_one_state_and_adds_rows(spark):
    base = spark.createDataFrame([raw("OREGON"), raw("OHIO")], RAW)
    newer = spark.createDataFrame([raw("OREGON", votes=5)], RAW).drop("magnitude")
    manual = spark.createDataFrame([("IOWA", "ADAIR", 3)], "state string, county_name string, votes long")
    got = O.assemble(base, newer, "OREGON", manual)
    assert cells(got, "state", "mode", "jurisdiction_name", "votes") == [("IOWA", "TOTAL", "ADAIR", 3), ("OHIO", "DAY", "WAYNE", 1), ("OREGON", "DAY", "WAYNE", 5)]
