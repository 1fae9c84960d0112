"""Manifest to partitioned ballots, over every file type, with faulty counties set aside."""

import gzip

from test_sources import export

from tallyline.plans.build import build_ballots, contests_of_manifest, county_ballots, scanned_together
from tallyline.plans.cleaning import party_lookup
from tallyline.sources.layout import read_partitioned

CONTESTS = (
    "state string, county_name string, contest string, office string, district string, candidate string, "
    "party_detailed string, magnitude string"
)


def test_build(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("Cvr Number,Precinct,Gov Ann,Gov Bob\n5,P1,1,0\n6,P1,0,0\n")
    (tmp_path / "banner.csv").write_text(
        "2020 General" + "," * 19 + "\nCvr Number,Gov,Gov" + ",Pad" * 17 + "\n,Ann,Bob" + "," * 17 + "\n,DEM,REP" + "," * 17 + "\n1,0,1" + "," * 17
        # the header block stands again mid-file
        + "\n2020 General" + "," * 19 + "\nCvr Number,Gov,Gov" + ",Pad" * 17 + "\n,Ann,Bob" + "," * 17 + "\n,DEM,REP" + "," * 17 + "\n2,1,0" + "," * 17 + "\n"
    )
    # cut short behind a good beginning
    (tmp_path / "cut.csv.gz").write_bytes(gzip.compress(b"Cvr Number,Gov Ann,Gov Bob\n" + b"".join(b"%d,1,%d\n" % (k, k * k % 7) for k in range(200_000)))[:-4000])
    (tmp_path / "broken.csv.gz").write_bytes(b"\x1f\x8b\x08\x00 no gzip")
    (tmp_path / "json").mkdir()
    export(tmp_path / "json")
    (tmp_path / "xml").mkdir()
    for k, name in enumerate(("Ann", "Bob")):
        (tmp_path / "xml" / f"{k}.xml").write_text(
            f"<CastVoteRecord><Contests><Contest><Name>Gov</Name><Options><Option><Name>{name}</Name></Option></Options>"
            "<Undervotes>0</Undervotes></Contest></Contests><PrecinctSplit><Name>S</Name></PrecinctSplit></CastVoteRecord>"
        )
    (tmp_path / "flags.csv").write_text("CVRNumber,Contest,Candidate,IsVote\n1,Gov,Ann,TRUE\n1,Gov,Bob,FALSE\n")
    files = [
        ("wide.csv", "OHIO", "WAYNE", "delim", None), ("banner.csv", "OHIO", "GREENE", "delim", None),
        ("json", "ARIZONA", "MARICOPA", "json", None), ("xml", "TEXAS", "WARD", "xml", None),
        ("flags.csv", "NEW JERSEY", "CUMBERLAND", "special", None), ("gone.csv", "OHIO", "LOST", "delim", None),
        ("cut.csv.gz", "OHIO", "CUT", "delim", None), ("broken.csv.gz", "OHIO", "BROKEN", "delim", None),
        ("x", "UTAH", "SAN JUAN", "special", None), ("wide.csv", "OHIO", "SKIPPED", "delim", "no"),
    ]
    manifest = spark.createDataFrame(
        [(str(tmp_path / f[0]), *f[1:]) for f in files], "path string, state string, county_name string, type string, build string"
    )
    named = [("Gov Ann", "Ann"), ("Gov Bob", "Bob"), ("Gov Ann Dem", "Ann"), ("Gov Bob Rep", "Bob"), ("Gov", None), ("Governor", None)]
    counties = {f[1:3] for f in files}
    contests = spark.createDataFrame([(*c, k, "governor", "statewide", n, None, "1") for c in counties for k, n in named], CONTESTS).replace(
        "statewide", "STATEWIDE"
    )
    parties = party_lookup(
        spark.createDataFrame(
            [("ohio", "governor", "ohio", "ann", "democrat", None), ("texas", "governor", "texas", "bob", "x", "duplicate")],
            "state string, office string, district string, candidate string, party_detailed string, issue string",
        )
    )
    out = str(tmp_path / "out")
    failed = build_ballots(spark, manifest, contests, parties, out, together=3)
    assert sorted(f[:2] for f in failed) == [("OHIO", "BROKEN"), ("OHIO", "CUT"), ("OHIO", "LOST"), ("UTAH", "SAN JUAN")]
    got = read_partitioned(spark, out).select("county_name", "cvr_id", "office", "district", "candidate", "party_detailed").collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        ("WAYNE", 1, "GOVERNOR", "OHIO", "ANN", "DEMOCRAT"), ("WAYNE", 2, "GOVERNOR", "OHIO", "UNDERVOTE", None),
        ("GREENE", 1, "GOVERNOR", "OHIO", "BOB", None), ("GREENE", 2, "GOVERNOR", "OHIO", "ANN", "DEMOCRAT"),
        ("CUMBERLAND", 1, "GOVERNOR", "NEW JERSEY", "ANN", None), ("WARD", 1, "GOVERNOR", "TEXAS", "ANN", None),
        *[r for r in map(tuple, got) if r[0] == "MARICOPA"],
    ], key=str)
    assert sorted(r["candidate"] for r in got if r["county_name"] == "MARICOPA") == ["ANN", "UNDERVOTE", "UNDERVOTE"]


def test_planning_delimited_counties_takes_no_jobs_of_their_own(spark, tmp_path):
    contests = spark.createDataFrame([("OHIO", f"C{k}", "Gov Ann", "GOVERNOR", None, "ANN", None, None) for k in range(12)], CONTESTS)
    for k in range(12):
        rows = "".join(f'{n},"first\nsecond",1\n' for n in range(k + 1))
        for part in range(2):
            (tmp_path / f"c{k}").mkdir(exist_ok=True)
            (tmp_path / f"c{k}" / f"{part}.csv").write_text("Cvr Number,Note,Gov Ann\n" + rows)

    def planned(n):
        spark.sparkContext.setJobGroup(f"plan{n}", "planning")
        paths = [str(tmp_path / f"c{k}") for k in range(n)]
        batch = scanned_together(spark, [*paths, str(tmp_path / "gone")])
        tables = [county_ballots(spark, "delim", p, "OHIO", f"C{k}", contests, batch) for k, p in enumerate(paths)]
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"plan{n}"))
        spark.sparkContext.setJobGroup("other", "reading")
        return tables, jobs

    (_, few), (tables, many) = planned(3), planned(12)
    # only the lookup of a county's contests is collected per county
    assert many - few <= 9 * lookup_jobs(spark, contests)
    for k in (0, 11):
        assert sorted(r["cvr_id"] for r in tables[k].select("cvr_id").collect()) == list(range(1, 2 * (k + 1) + 1))


def lookup_jobs(spark, contests):
    """Jobs that reading one county's contests to the driver takes."""
    spark.sparkContext.setJobGroup("lookup", "lookup")
    contests.where("county_name = 'C0'").collect()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("lookup"))
    spark.sparkContext.setJobGroup("other", "reading")
    return jobs


def test_contests_from_the_manifest(spark, tmp_path):
    for k, header in enumerate(("Cvr Number,Gov,gov,House", "Cvr Number,Senate", "2020 General" + "," * 19)):
        (tmp_path / f"{k}.csv").write_text(header + "\n1,1,1,1\n")
    (tmp_path / "x.xml").write_text(
        "<CastVoteRecord><Contests><Contest><Name>Mayor</Name><Options><Option><Name>Ann</Name></Option></Options>"
        "<Undervotes>0</Undervotes></Contest></Contests><PrecinctSplit><Name>S</Name></PrecinctSplit></CastVoteRecord>"
    )
    files = [("0.csv", "A", "delim"), ("1.csv", "B", "delim"), ("x.xml", "C", "xml"), ("gone.csv", "D", "delim")]
    rows = [(str(tmp_path / p), "OHIO", c, t, None) for p, c, t in files]
    found = contests_of_manifest(spark, spark.createDataFrame(rows, "path string, state string, county_name string, type string, build string"))
    assert sorted((r["county_name"], r["contest"]) for r in found.collect()) == [
        ("A", "Gov...2"), ("A", "House"), ("A", "gov...3"), ("B", "Senate"), ("C", "Mayor"),
    ]
