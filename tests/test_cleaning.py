"""Ballot cleaning: undervotes, text rules, adapters."""

import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators.groups import first_per_key
from tallyline.plans import cleaning as K
from tallyline.sources.delimited import read_wide_ballots

CONTESTS = (
    "state string, county_name string, contest string, office string, district string, candidate string, "
    "party_detailed string, magnitude string"
)


def cells(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_wide_file_to_long_table(spark, tmp_path):
    (tmp_path / "cvr.csv").write_text(
        "Cvr Number,Precinct Portion,President (Biden),President (Trump),Sheriff,Nobody\n"
        "9,P1,1,0,Smith (REP),1\n"       # votes for Biden and Smith
        "8,P1,0,0,undervote,1\n"         # no vote for president, labelled undervote
        "7,P2,*,0,,1\n"                  # redacted and no vote: hidden cell is unknown, the 0 an undervote
        "6,P2,0,1,\"O'Neil, Dem\",1\n"
    )
    contests = spark.createDataFrame(
        [
            ("ohio", "wayne", "President (Biden)", "us president", "federal", "Joe Biden", None, "1"),
            ("ohio", "wayne", "President (Trump)", "us president", "federal", "D. Trump", None, "1"),
            ("ohio", "wayne", "Sheriff", "sheriff", "county_name", None, None, "1"),
            ("ohio", "adams", "Nobody", "nobody", "x", None, None, "1"),
        ],
        CONTESTS,
    ).withColumns({"state": F.upper("state"), "county_name": F.upper("county_name")})
    long = K.clean_wide(read_wide_ballots(spark, str(tmp_path / "cvr.csv")), "OHIO", "WAYNE", contests)
    assert long.columns == list(K.LONG_COLUMNS)
    assert cells(long, "cvr_id", "precinct", "office", "district", "candidate", "party_detailed") == [
        (1, "P1", "SHERIFF", "WAYNE", "SMITH", "REPUBLICAN"),
        (1, "P1", "US PRESIDENT", "FEDERAL", "JOSEPH R BIDEN", "DEMOCRAT"),
        (2, "P1", "SHERIFF", "WAYNE", "UNDERVOTE", None),
        (2, "P1", "US PRESIDENT", "FEDERAL", "UNDERVOTE", None),
        (3, "P2", "US PRESIDENT", "FEDERAL", "UNDERVOTE", None),
        (4, "P2", "SHERIFF", "WAYNE", "ONEIL", "DEMOCRAT"),
        (4, "P2", "US PRESIDENT", "FEDERAL", "DONALD J TRUMP", "REPUBLICAN"),
    ]


@pytest.mark.parametrize("text, office, stated, candidate, party", [
    ("Indira Gandhi", "US HOUSE", None, "INDIRA GANDHI", None),          # no mark, nothing stripped
    ("IND Smith", "US HOUSE", None, "SMITH", "INDEPENDENT"),
    ("José Núñez (DEM)", "US HOUSE", None, "JOSE NUNEZ", "DEMOCRAT"),
    ("Write-in: x", "US HOUSE", None, "WRITEIN", "WRITEIN"),
    ("Gloria La Riva", "US PRESIDENT", None, "GLORIA LA RIVA", None),
    ("PGP Gloria La Riva", "US PRESIDENT", None, "GLORIA LA RIVA", "SOCIALIST"),
    ("Rocky De La Fuente", "US PRESIDENT", "alliance", "ROCQUE DE LA FUENTE", "REFORM"),
    ("Biden", "US HOUSE", "Working Families", "BIDEN", "WORKING FAMILIES"),
    ("overvote", "US HOUSE", "dem", "OVERVOTE", None),
    ("  Ann   B.  Cee  DFL", "US HOUSE", None, "ANN B CEE", "DEMOCRAT"),
    ("NME Doe", "US HOUSE", None, "DOE", "END THE CORRUPTION"),
    ("Doe (Nonpartisan)", "US HOUSE", None, "DOE", None),
])
def test_candidate_text(spark, text, office, stated, candidate, party):
    df = spark.createDataFrame([(text, office, stated)], "candidate string, office string, party_detailed string")
    assert cells(K.clean_text(df), "candidate", "party_detailed") == [(candidate, party)]


def test_wide_and_long_undervote_rules_agree(spark):
    lookup = spark.createDataFrame(
        [("a", "X", "1", "Ann"), ("b", "X", "1", "Bob"), ("c", "Y", None, None)],
        "contest string, office string, district string, candidate string",
    )
    grid = [(k, *row) for k, row in enumerate([("1", "0", "Cy"), ("0", "X", None), (None, None, "0"), ("*", "redacted", "UNDERVOTE 1"), (None, "0", "x")])]
    wide = spark.createDataFrame(grid, "cvr_id int, a string, b string, c string")
    from_wide = K.unpivot_ballots(wide, lookup, ids=["cvr_id"])
    long = wide.unpivot(["cvr_id"], None, "contest", "cell").where("cell is not null").join(lookup.withColumnRenamed("candidate", "named"), "contest")
    from_long = K.infer_undervotes(long, "cell", "named", ["cvr_id", "office", "district"])
    columns = ("cvr_id", "contest", "voted", "candidate")
    assert cells(from_wide, *columns) == cells(from_long, *columns)
    assert (0, "a", True, "Ann") in cells(from_wide, *columns)
    assert (1, "a", False, "undervote") in cells(from_wide, *columns)
    assert (1, "b", False, None) in cells(from_wide, *columns)


def test_single_choices_equal_the_fold_of_all_choices(spark):
    rng = random.Random(7)
    entries = [(f"c{k}", rng.choice(["X", "Y", None]), rng.choice(["1", None]), rng.choice([None, "Ann", "Bob"]), rng.choice([None, "G"])) for k in range(9)]
    entries += [("c1", "X", "1", "Ann", None), ("c1", "X", "1", "Bob", "A"), ("c2", "Y", "1", None, None), ("absent", "X", "1", None, None)]
    lookup = spark.createDataFrame(entries, "contest string, office string, district string, candidate string, party_detailed string")
    cell = lambda: rng.choice([None, "0", "1", "Ann", "Bob", "*", "undervote", "redacted", ""])
    wide = spark.createDataFrame(
        [("S", "C", k, "p", *[cell() for _ in range(9)]) for k in range(300)],
        "state string, county_name string, cvr_id int, precinct string, " + ", ".join(f"c{k} string" for k in range(9)),
    )
    key = ["state", "county_name", "cvr_id", "office", "district", "candidate"]
    folded = first_per_key(K.unpivot_ballots(wide, lookup).dropna(subset=["candidate"]), key, ("__pos",))
    columns = (*key, "precinct", "party_detailed", "contest")
    single = K.single_choices(wide, lookup)
    assert cells(single, *columns) == cells(folded, *columns)
    assert "Exchange hashpartitioning" not in single._jdf.queryExecution().toString()


def test_clean_wide_shuffles_no_choice(spark):
    contests = spark.createDataFrame([("S", "C", "a", "X", "1", "Ann", None, "1")], CONTESTS)
    wide = spark.createDataFrame([(1, "1")], f"`{K.NUMBERED}` long, a string")
    plan = K.clean_wide(wide, "S", "C", contests)
    assert cells(plan, "candidate") == [("ANN",)]
    assert "hashpartitioning" not in plan._jdf.queryExecution().toString()


MARKS = "cvr_id int, contest string, precinct string, magnitude string, candidate string, party_detailed string, isVote boolean, isAmbiguous boolean, undervotes int, overvotes int"


def test_votes_fall_into_disjoint_classes(spark):
    marks = [
        (1, "A", "p", "1", "X", "D", True, False, 0, 0),        # valid
        (1, "A", "p", "2", "Y", "D", False, True, 1, 0),        # rest of a contest with a valid vote
        (2, "A", "p", None, None, None, False, False, 1, 0),    # undervote without marks
        (3, "A", "p", "1", "X", "D", True, True, 1, 0),         # all ambiguous: an undervote
        (4, "A", "p", "1", "X", "D", False, True, 1, 0),        # part ambiguous: only the clear mark counts
        (4, "A", "p", "2", "Y", "D", False, False, 1, 0),
        (5, "A", "p", "1", "X", "D", False, False, 0, 1),       # overvote, two marks of one rank
        (5, "A", "p", "1", "Y", "D", False, False, 0, 1),
    ]
    got = K.vote_partition(spark.createDataFrame(marks, MARKS))
    assert cells(got, "cvr_id", "magnitude", "candidate", "vote_class") == [
        (1, "1", "X", "VALID"), (2, None, "UNDERVOTE", "UNDERVOTE"), (3, "1", "UNDERVOTE", "UNDERVOTE"),
        (4, "2", "UNDERVOTE", "UNDERVOTE"), (5, "1", "OVERVOTE", "OVERVOTE"),
    ]


def test_alaska_jurisdiction_comes_from_the_precinct(spark):
    rows = [("ALASKA", "STATEWIDE", 1, "US HOUSE", "000", "A", None, "c", "District 7, Precinct 2"),
            ("OHIO", "WAYNE", 1, "US HOUSE", "001", "A", None, "c", "District 7")]
    df = spark.createDataFrame(rows, "state string, county_name string, cvr_id int, office string, district string, candidate string, party_detailed string, contest string, precinct string")
    assert cells(K.clean(df), "jurisdiction_name") == [("DISTRICT 7",), ("WAYNE",)]


def test_first_of_repeated_choices_stays(spark):
    df = spark.createDataFrame(
        [("S", "C", 1, "O", "1", "A", None, "zeta"), ("S", "C", 1, "O", "1", "A", "Green", "alpha")],
        "state string, county_name string, cvr_id int, office string, district string, candidate string, party_detailed string, contest string",
    )
    assert cells(K.clean(df), "contest", "party_detailed") == [("alpha", "GREEN")]


def test_contest_lookup_tokens_and_statewide_rows(spark):
    raw = spark.createDataFrame(
        [
            ("ALASKA", None, "House é", "US House", "1", "Ann", "NA", "1"),
            ("OHIO", "WAYNE", "Sheriff", "Sheriff", "COUNTY_NAME", "Bob", "#N/A", "1"),
            ("OHIO", "WAYNE", "Gov", "Governor", "STATEWIDE", "", "x", "1"),
            ("OHIO", "WAYNE", None, "Governor", "STATEWIDE", "", "x", "1"),
        ],
        CONTESTS,
    )
    got = K.contest_lookup(raw, "OHIO", "WAYNE")
    assert cells(got, "contest", "office", "district", "candidate", "party_detailed") == [
        ("Gov", "GOVERNOR", "OHIO", None, "X"), ("Sheriff", "SHERIFF", "WAYNE", "BOB", None)]
    assert cells(K.contest_lookup(raw, "ALASKA", "ANYWHERE"), "contest", "district", "county_name") == [("House ", "001", "")]


def test_party_lookup(spark):
    raw = spark.createDataFrame([("ohio", "state house", "7", "Ann", "Democrat", None), ("ohio", "governor", "x", None, "y", None)],
                                "state string, office string, district string, name string, party_detailed string, issue string")
    assert cells(K.party_lookup(raw, "name"), "state", "district", "candidate", "party_detailed") == [("OHIO", "007", "ANN", "DEMOCRAT")]


def contests(spark, *rows):
    return spark.createDataFrame([("S", "C", *r) for r in rows], CONTESTS)


def test_race_export_variant(spark):
    raw = spark.createDataFrame(
        [("1", "p", "Pres", "DEM Joseph R. Biden"), ("2", "p", "Pres", "0"), ("3", "p", "House", "NPA Jane (NPA)"), ("4", "p", "Else", "x")],
        "cid string, Precinct string, Race string, Candidate string",
    )
    table = contests(spark, ("Pres", "US PRESIDENT", "FEDERAL", None, None, "1"), ("House", "US HOUSE", "1", None, None, "1"))
    got = K.clean_race_export(raw, "S", "C", table)
    assert cells(got, "cvr_id", "office", "district", "candidate", "party_detailed") == [
        ("1", "US PRESIDENT", "FEDERAL", "JOSEPH R BIDEN", "DEMOCRAT"), ("2", "US PRESIDENT", "FEDERAL", "UNDERVOTE", None),
        ("3", "US HOUSE", "001", "JANE ", "NONPARTISAN")]


def test_vote_flag_and_stacked_exports(spark):
    raw = spark.createDataFrame([(1, "Gov", " Ann   Lee ", "true"), (1, "Gov", "Bob", "false")], "CVRNumber int, Contest string, Candidate string, IsVote string")
    table = contests(spark, ("Gov", "GOVERNOR", "S", None, "green", "1"))
    assert cells(K.clean_vote_flags(raw, "S", "C", table), "candidate", "party_detailed") == [("ANN LEE", "GREEN")]
    stacked = spark.createDataFrame([(1, "p", "Gov", "DEM Ann"), (1, "p", "PROPOSITION", "Yes"), (2, "p", "Gov", "Write-in")],
                                    "cvrNumber int, precinct string, contest string, candidate string")
    assert cells(K.clean_stacked_export(stacked, "S", "C", table), "candidate", "party_detailed") == [
        ("DEM ANN", None), ("WRITEIN", None), ("YES", "NONPARTISAN")]


def test_second_pass_party(spark):
    rows = spark.createDataFrame([("S", "O", "1", "A", "X"), ("S", "O", "1", "B", "X"), ("S", "O", "1", "C", "X")],
                                 "state string, office string, district string, candidate string, party_detailed string")
    meta = spark.createDataFrame([("S", "O", "1", "A", "NEW", None), ("S", "O", "1", "B", None, "dup")],
                                 "state string, office string, district string, candidate string, party_detailed string, issue string")
    assert cells(K.merge_party(rows, meta), "candidate", "party_detailed") == [("A", "NEW"), ("C", "X")]


def test_file_without_a_known_contest_is_an_error(spark):
    wide = spark.createDataFrame([(1, "1")], "cvr_id int, a string")
    lookup = spark.createDataFrame([("z", "X", "1", "Ann")], "contest string, office string, district string, candidate string")
    with pytest.raises(ValueError, match="no column"):
        K.unpivot_ballots(wide, lookup, ids=["cvr_id"])


def test_race_export_folds_votes_and_choices_together(spark):
    raw = spark.createDataFrame(
        [("1", "p", "Pres A", "0"), ("1", "p", "Pres B", "Ann"), ("1", "p", "Pres A", "Ann"), ("1", "p", "Pres A", "Undervote"),
         ("2", "p", "Pres B", "0"), ("2", "p", "Pres A", "undervote"), ("3", "p", "Pres A", None), ("3", "p", "Pres A", "0"),
         (None, "p", "Pres A", "0"), (None, "q", "Pres A", "Bob"), (None, "q", "Pres A", "Bob")],
        "cid string, Precinct string, Race string, Candidate string",
    ).repartition(3)
    table = contests(spark, ("Pres A", "US HOUSE", None, None, None, "1"), ("Pres B", "US HOUSE", None, None, None, "2"))
    got = K.clean_race_export(raw, "S", "C", table)
    assert cells(got, "cvr_id", "precinct", "candidate", "contest", "magnitude") == [
        ("1", "p", "ANN", "Pres A", "1"), ("1", "p", "UNDERVOTE", "Pres A", "1"),
        ("2", "p", "UNDERVOTE", "Pres A", "1"), (None, "q", "BOB", "Pres A", "1")]
    # the lookup and the repartition aside, ballots are exchanged once and joined once
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1 and plan.count("ENSURE_REQUIREMENTS") <= 3
