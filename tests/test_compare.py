"""Alignment, county classes, traffic light, release flag."""

import pytest
from pyspark.sql import functions as F

from tallyline.plans import compare as C

ALIGNED = (
    "state string, county_name string, office string, district string, party_detailed string, special int, writein int, "
    "candidate_h string, votes_h long, candidate_m string, votes_m long, candidate_c string, votes_c long, candidate_v string, votes_v long"
)


def aligned(spark, cells):
    """cells: (county, office, party, votes_c, votes_v); a missing tally has no candidate."""
    made = [
        ("ST", county, office, "001", party, 0, 0, None, None, None, None, "X" if c is not None else None, c, "X" if v is not None else None, v)
        for county, office, party, c, v in cells
    ]
    return spark.createDataFrame(made, ALIGNED)


def classes(spark, cells, **options):
    return {r["county_name"]: r["color2_c"] for r in C.classify(aligned(spark, cells), "c", **options).collect()}


def test_every_class(spark):
    d, r = "DEMOCRAT", "REPUBLICAN"
    cells = [
        ("exact", "GOVERNOR", d, 100, 100), ("exact", "US HOUSE", r, 7, 7),
        ("below1", "GOVERNOR", d, 1000, 1001), ("below1", "US HOUSE", r, 7, 7),
        ("below5", "GOVERNOR", d, 980, 1000),
        ("below10", "GOVERNOR", d, 930, 1000), ("below10", "US HOUSE", r, 7, 7),
        ("red", "GOVERNOR", d, 500, 1000), ("red", "US HOUSE", r, 7, 7),
        ("some", "GOVERNOR", d, None, 1000), ("some", "US HOUSE", r, 7, 7),
        ("none", "GOVERNOR", d, None, 1000), ("none", "US HOUSE", r, None, 7),
        ("noreturn", "GOVERNOR", d, 10, None), ("noreturn", "US HOUSE", r, 7, 7),
        ("tenth", "GOVERNOR", d, 900, 1000),
        ("zero", "GOVERNOR", d, 5, 0),
        ("other", "GOVERNOR", "GREEN", 1, 99), ("other", "US HOUSE", d, 5, 5),
    ]
    assert classes(spark, cells) == {
        "exact": "0 difference", "below1": "any < 1% mismatch", "below5": "any < 5% mismatch", "below10": "any < 10% mismatch",
        "red": "red", "some": "candidate missing", "none": "not collected", "noreturn": "no entry in returns",
        "tenth": "unclassified", "zero": "red", "other": "0 difference",
    }


def test_offsetting_candidates_of_one_party_cancel(spark):
    cells = [("x", "GOVERNOR", "DEMOCRAT", 10, 11), ("x", "GOVERNOR", "DEMOCRAT", 11, 10)]
    assert classes(spark, cells) == {"x": "0 difference"}


def test_county_set_by_hand(spark):
    assert classes(spark, [("x", "GOVERNOR", "DEMOCRAT", 5, 5)], set_by_hand={("ST", "x"): "unclassified"}) == {"x": "unclassified"}


def test_release_flag_follows_class(spark):
    df = spark.createDataFrame([(c,) for c in (*C.CLASSES, None)], "color2_c string")
    flags = {r["color2_c"]: r["f"] for r in df.select("color2_c", C.release_flag().alias("f")).collect()}
    assert [c for c, f in flags.items() if f == 1] == ["0 difference", "any < 1% mismatch"]
    assert flags[None] == 0


LIGHT = "state string, county_name string, party_detailed string, votes_c long, votes_v long"


def test_traffic_light(spark):
    d = "DEMOCRAT"
    cells = [("ST", "green", d, 5, 5), ("ST", "green", "GREEN", 5, 500)]
    cells += [("ST", "yellow", d, 100, 105)] * 5 + [("ST", "yellow", d, None, 3)]
    cells += [("ST", "missing", d, 100, 100)] * 4 + [("ST", "missing", d, None, 3)]
    cells += [("ST", "far", d, 100, 111)]
    cells += [("ST", "zero", d, 0, 4), ("ST", "double", d, 4, 8)]
    cells += [("COLORADO", "ARAPAHOE", d, 5, 5)]
    got = {r["county_name"]: r["color"] for r in C.traffic_light(spark.createDataFrame(cells, LIGHT)).collect()}
    # five rows with one missing: one is not below a fifth of five
    assert got == {
        "green": "green", "yellow": "yellow", "missing": "red", "far": "red", "zero": "red", "double": "red", "ARAPAHOE": "red",
    }


BALLOTS = "state string, county_name string, office string, district string, candidate string, party_detailed string"


def test_ranked_tally_relabels_and_breaks_ties_by_name(spark):
    rows = [("ALASKA", "JUNEAU", "GOVERNOR", "A", c, p) for c, p in
            [("B", "DEMOCRAT"), ("A", "DEMOCRAT"), ("UNDERVOTE", None), ("UNDERVOTE", "DEMOCRAT"), ("Z", "WHIG"), ("WRITEIN", "X")]]
    got = C.ranked_tally(spark.createDataFrame(rows, BALLOTS)).select(
        "county_name", "candidate", "party_detailed", "votes", "cand_rank").collect()
    assert sorted(map(tuple, got)) == [
        ("STATEWIDE", "A", "DEMOCRAT", 1, 1), ("STATEWIDE", "B", "DEMOCRAT", 1, 2),
        ("STATEWIDE", "UNDERVOTE", "UNDERVOTE", 2, 1), ("STATEWIDE", "WRITEIN", "WRITEIN", 1, 1),
    ]


def side(spark, rows, extra=""):
    return spark.createDataFrame(rows, BALLOTS.replace("party_detailed string", "party_detailed string, votes long, cand_rank int") + extra)


def test_alignment_drops_keys_only_the_release_has(spark):
    row = lambda c, n, k, d="1": ("S", "C", "GOVERNOR", d, c, "DEMOCRAT", n, k)
    h = side(spark, [row("A", 5, 1)])
    m = side(spark, [row("A", 6, 1), row("B", 1, 2)])
    c = side(spark, [row("A", 7, 1), row("only c", 9, 3), row("c and v", 4, 4), row("null", 3, 1, None)])
    v = side(spark, [(*row("A", 8, 1), 0, 0), (*row("V", 2, 4), 0, 0), (*row("null", 3, 1, None), 0, 0)], ", writein int, special int")
    got = C.align_candidates(h, m, c, v).select("district", "votes_h", "votes_m", "votes_c", "votes_v", "candidate_c").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [("1", 5, 6, 7, 8, "A"), ("1", None, 1, None, None, None), ("1", None, None, None, 2, None), (None, None, None, None, 3, None)],
        key=str,
    )


def test_county_table_and_match_table(spark):
    made = [
        ("S", "one", "GOVERNOR", "1", "DEMOCRAT", 0, 0, "A", 5, "A", 5, "A", 5, "A", 5),
        ("S", "one", "US HOUSE", "1", "REPUBLICAN", 0, 0, "A", 4, "A", 5, "A", 5, "A", 5),
        ("S", "two", "GOVERNOR", "1", "LIBERTARIAN", 0, 0, None, None, "A", 5, None, None, "A", 9),
    ]
    table = C.county_table(spark.createDataFrame(made, ALIGNED))
    got = {r["county_name"]: r.asDict() for r in table.collect()}
    assert (got["one"]["match_score_h"], got["one"]["match_score_m"], got["one"]["release"]) == (0.5, 1.0, 1)
    assert (got["two"]["color2_c"], got["two"]["color2_h"], got["two"]["release"]) == ("not collected", "not collected", 0)
    assert got["one"]["stgov_votes_v"] == 5 and got["one"]["ushou_diff_h"] == 1 and got["two"]["ushou_votes_v"] is None
    cells = {(r["match_h"], r["match_m"]): r["n"] for r in C.match_table(table).collect()}
    assert cells[("Sum", "Sum")] == 2 and cells[("0", "1")] == 1
    assert C.class_table(table, "color2_c").agg(F.sum("n")).head()[0] == 2


def test_coalesced_comparison_keeps_counties_with_ballots(spark):
    rows = aligned(spark, [("has", "GOVERNOR", "DEMOCRAT", 5, 10), ("has", "GOVERNOR", "UNDERVOTE", None, 3), ("not", "GOVERNOR", "DEMOCRAT", None, 3)])
    county = spark.createDataFrame([("ST", "has", 1)], "state string, county_name string, release int")
    got = C.coalesced_comparison(rows, county).select("county_name", "party_detailed", "release", "diff_pct").collect()
    assert sorted(map(tuple, got)) == [("has", "DEMOCRAT", 1, "0.500"), ("has", "UNDERVOTE", 1, None)]


@pytest.mark.parametrize("party, expected", [("undervote", "UNDERVOTE"), ("NPA", "NO PARTY AFFILIATION")])
def test_second_team_party_spelling(spark, party, expected):
    rows = spark.createDataFrame([("S", "C", "GOVERNOR", "1", "A", party)], BALLOTS)
    assert C.second_team_tally(rows).head()["party_detailed"] == expected
