"""Readers and writers on tiny files."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyline.plans.cleaning import discover_contests, vote_partition
from tallyline.session import scratch_path, written_once
from tallyline.sources import delimited as D
from tallyline.sources import layout as Y
from tallyline.sources import nested as M


def cells(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


def test_typed_csv_trims_and_reads_missing_tokens(spark, tmp_path):
    (tmp_path / "x.csv").write_text('state, county_name,n\nVIRGINIA, "",3\nOHIO, MONROE,NA\nTEXAS, #N/A,4\n')
    df = D.read_typed_csv(spark, str(tmp_path / "x.csv"), "state string, county_name string, n int")
    assert cells(df) == [("OHIO", "MONROE", None), ("TEXAS", None, 4), ("VIRGINIA", None, 3)]


def test_wide_names_are_repaired_and_quoted_newlines_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Id,Pres,Pres,,"Two\nlines"\n1,a,b,c,"x, ""y"""\n2,,b2,,\n')
    df = D.read_wide_ballots(spark, str(tmp_path / "a.csv"), row_source=False)
    assert df.columns == ["Id", "Pres...2", "Pres...3", "...4", "Two\nlines"]
    assert [tuple(r) for r in df.collect()] == [("1", "a", "b", "c", 'x, "y"'), ("2", None, "b2", None, None)]


@pytest.mark.parametrize("multi_line", [True, False])
def test_row_numbers_follow_file_order_over_splits(spark, tmp_path, multi_line):
    for name, start, n in (("a.csv", 0, 4000), ("b.csv", 4000, 900)):
        (tmp_path / name).write_text("v,pad\n" + "".join(f"{k},{'x' * 30}\n" for k in range(start, start + n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = D.read_wide_ballots(spark, str(tmp_path), multi_line=multi_line).withColumn("county", F.lit("c"))
        over_all = D.number_rows(raw, "idx", ["county"])
        assert over_all.where(F.col("idx") != F.col("v").cast("int") + 1).count() == 0 and over_all.count() == 4900
        per_file = D.number_rows(raw, "idx")
        assert per_file.agg(F.max("idx"), F.count_distinct("idx")).head() == (4000, 4000)
        if not multi_line:
            assert raw.rdd.getNumPartitions() > 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_stacked_headers_with_a_repeated_block(spark, tmp_path):
    lines = ["2020 General Election,,", "Cvr Number,President (Vote for 1),President (Vote for 1)",
             ",Joseph R. Biden and Kamala D. Harris,Donald J. Trump", ",DEM,REP", "1,1,0", "2,0,1",
             "2020 General Election,,", "Cvr Number,President (Vote for 1),President (Vote for 1)",
             ",Joseph R. Biden and Kamala D. Harris,Donald J. Trump", ",DEM,REP", "3,1,0"]
    path = tmp_path / "h.csv"
    path.write_text("\n".join(lines) + "\n")
    assert D.has_banner(spark, str(path))
    df = D.drop_row_source(D.read_multi_header(spark, str(path), probe=2))
    assert df.columns == ["Cvr Number", "President Vote for 1 Joseph r Biden and Kamala d Harris Dem", "President Vote for 1 Donald j Trump Rep"]
    assert cells(df) == [("1", "1", "0"), ("2", "0", "1"), ("3", "1", "0")]


def test_plain_file_has_no_banner(spark, tmp_path):
    (tmp_path / "p.csv").write_text("Cvr Number,x\n1,2\n")
    assert not D.has_banner(spark, str(tmp_path / "p.csv"))


def test_files_of_different_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,x\n1,2\n")
    (tmp_path / "b.csv").write_text("k,y\n3,4\n")
    df = D.read_many(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert cells(df, "k", "x", "y") == [("1", "2", None), ("3", None, "4")]


@pytest.mark.parametrize("multi_line", [True, False])
def test_records_wider_than_their_header_are_an_error(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text('Id,Pres,Sen\n1,a,b\n2,"c, ""d"", e, f"\n3,a,b,,""\n4\n')
    df = D.read_wide_ballots(spark, str(tmp_path / "a.csv"), multi_line=multi_line)
    assert cells(df, "Id", "Pres", "Sen") == [("1", "a", "b"), ("2", 'c, "d", e, f', None), ("3", "a", "b"), ("4", None, None)]
    assert df.count() == 4
    for record in ("5,a,b,lost", '5,a,b,"lost, ""x"""', "5,a,b,,lost"):
        (tmp_path / "b.csv").write_text(f"Id,Pres,Sen\n1,a,b\n{record}\n6,a,b\n")
        wide = D.read_wide_ballots(spark, str(tmp_path / "b.csv"), multi_line=multi_line)
        for cut in (wide, wide.select("Pres")):
            with pytest.raises(PySparkException, match="more than 3 cells; it begins with 5"):
                cut.collect()


def test_records_wider_than_stacked_headers_are_an_error(spark, tmp_path):
    (tmp_path / "h.csv").write_text("2020 General\n,Pres,Sen\n,A,B\nId,x,y\n1,1,0\n2,0,1,1\n")
    with pytest.raises(PySparkException, match="more than 3 cells; it begins with 2"):
        D.read_multi_header(spark, str(tmp_path / "h.csv"), probe=2).collect()


def test_totals_row_and_cell_fixes(spark):
    df = spark.createDataFrame([("a", 1, "1 (50%)"), ("a", 2, "0 (3%) z"), ("b", 1, "t")], "f string, idx int, c string")
    assert cells(D.drop_last_row(D.fix_cells(df, [D.MARK_WITH_SHARE], ["c"]), "idx", ["f"]), "f", "idx", "c") == [("a", 1, "1")]
    assert cells(D.fix_cells(df, [D.MARK_WITH_SHARE], ["c"]), "c") == [("0 z",), ("1",), ("t",)]


def export(folder):
    def manifest(name, entries):
        (folder / f"{name}Manifest.json").write_text(json.dumps({"Version": "5", "List": entries}, indent=1))

    manifest("District", [{"Description": "Countywide", "Id": 1}])
    manifest("Contest", [{"Description": "Governor", "Id": 10, "DistrictId": 1}])
    manifest("Candidate", [{"Description": "Ann", "Id": 100, "Type": "Regular"}])
    manifest("Party", [{"Description": "Republican Party", "Id": 7}, {"Description": "Whig", "Id": 8}])
    manifest("PrecinctPortion", [{"Description": "P 1", "Id": 5, "PrecinctId": 50}])

    def side(current, vote, under=0, marks=True):
        made = [{"CandidateId": 100, "PartyId": 7, "Rank": 1, "IsAmbiguous": False, "IsVote": vote}] if marks else []
        contest = {"Id": 10, "Undervotes": under, "Overvotes": 0, "Marks": made}
        return {"PrecinctPortionId": 5, "IsCurrent": current, "Cards": [{"Id": 1, "Contests": [contest]}]}

    sessions = [
        {"TabulatorId": 1, "BatchId": 1, "RecordId": 1, "Original": side(True, True)},
        {"TabulatorId": 1, "BatchId": 1, "RecordId": 2, "Original": side(False, True), "Modified": side(True, False, 1)},
        {"TabulatorId": 1, "BatchId": 2, "RecordId": 1, "Original": side(True, False, 1, marks=False)},
    ]
    (folder / "CvrExport_1.json").write_text(json.dumps({"Version": "5", "Sessions": sessions[:2]}, indent=1))
    (folder / "CvrExport_2.json").write_text(json.dumps({"Version": "5", "Sessions": sessions[2:]}))


def test_json_export_to_votes(spark, tmp_path):
    export(tmp_path)
    marks = M.read_json_ballots(spark, str(tmp_path))
    assert marks.count() == 3 and marks.select("cvr_id").distinct().count() == 3
    assert cells(vote_partition(marks), "contest", "precinct", "candidate", "party_detailed", "magnitude") == [
        ("Governor", "P 1", "Ann", "REPUBLICAN", "1"), ("Governor", "P 1", "UNDERVOTE", None, "1"),
        ("Governor", "P 1", "UNDERVOTE", None, None)]


def test_xml_ballots(spark, tmp_path):
    def ballot(options, under="0"):
        return (f"<CastVoteRecord><Contests><Contest><Name>Gov\nernor</Name><Options>{options}</Options><Undervotes>{under}</Undervotes>"
                "</Contest></Contests><PrecinctSplit><Name>P1</Name></PrecinctSplit></CastVoteRecord>")

    two = "<Option><Name>Ann</Name></Option><Option><Name>Bob</Name></Option>"
    for folder in ("b", "a"):
        (tmp_path / folder / "sub").mkdir(parents=True)
        for k, text in enumerate([ballot(two), ballot("<Option><WriteInData><Text>Me</Text></WriteInData></Option>"), ballot("", "1"), ballot("")]):
            (tmp_path / folder / ("sub" if k == 2 else "") / f"{k}.xml").write_text(text)
    for folder in ("b", "a"):  # numbers follow the paths below the folder, wherever it lies; sub-folders and second options count
        got = M.read_xml_ballots(spark, str(tmp_path / folder))
        assert cells(got, "cvr_id", "contest", "candidate", "precinct") == sorted([
            (1, "Gov ernor", "Ann", "P1"), (1, "Gov ernor", "Bob", "P1"), (2, "Gov ernor", "WRITEIN", "P1"),
            (4, "Gov ernor", "undervote", "P1"), (3, "Gov ernor", None, "P1")], key=str)


def test_exports_in_sub_folders(spark, tmp_path):
    export(tmp_path)
    (tmp_path / "batch2").mkdir()
    (tmp_path / "CvrExport_2.json").rename(tmp_path / "batch2" / "CvrExport_2.json")
    assert M.read_json_ballots(spark, str(tmp_path)).count() == 3


def test_headers_of_differing_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Cvr,Gov Ann,Gov Bob\n1,1,0\n2,0,1\n")
    (tmp_path / "b.csv").write_text("Cvr,Gov Bob,Gov Ann,More\n3,1,0,x\n")
    (tmp_path / "c.csv").write_text("")
    got = D.read_wide_ballots(spark, str(tmp_path / "*.csv"))
    assert cells(got, "Cvr", "Gov Ann", "Gov Bob", "More") == [("1", "1", "0", None), ("2", "0", "1", None), ("3", "0", "1", "x")]


def test_numbers_close_the_gaps_of_removed_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(D, "STRETCH", 4)
    for name, n in (("a", 23), ("b", 9)):
        (tmp_path / f"{name}.csv").write_text("v\n" + "".join(f"{name}{k:02}\n" for k in range(n)))
    raw = D.read_wide_ballots(spark, str(tmp_path / "*.csv")).withColumn("county", F.lit("X"))
    kept = raw.where(~F.col("v").isin("a05", "a06", "a07", "a08", "a09", "b00", "b04"))
    got = D.number_rows(kept, "idx", ["county"]).select("v", "idx").collect()
    want = sorted(r["v"] for r in kept.select("v").collect())
    assert sorted(map(tuple, got)) == [(v, k + 1) for k, v in enumerate(want)]


def test_replace_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [("OHIO", "WAYNE", 1), ("OHIO", "ADAMS", 2), ("MARYLAND", "PRINCE GEORGE'S", 3)]
    Y.write_partitioned(spark.createDataFrame(rows, "state string, county_name string, v int"), path, ["state", "county_name"], "overwrite")
    Y.write_partitioned(spark.createDataFrame([("OHIO", "WAYNE", 9)], "state string, county_name string, v int"), path, ["state", "county_name"], "replace")
    assert cells(Y.read_partitioned(spark, path), "county_name", "v") == [("PRINCE GEORGE'S", 3), ("ADAMS", 2), ("WAYNE", 9)]
    pruned = Y.read_partitioned(spark, path).where("state = 'OHIO'")
    assert "PartitionFilters: [isnotnull(state" in pruned._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        Y.write_partitioned(pruned, path, ["state"], "static")


def test_partition_keys_stay_text_and_schema_is_forced(spark, tmp_path):
    path = str(tmp_path / "fips")
    spark.createDataFrame([("01", 1.5)], "fips string, v double").write.partitionBy("fips").parquet(path)
    assert Y.read_partitioned(spark, path).head() == (1.5, "01")
    assert Y.read_partitioned(spark, path, "v double, extra string, fips string").head() == (1.5, None, "01")


def test_manifest_and_stale_partitions(spark):
    manifest = spark.createDataFrame([("OHIO", "WAYNE", "delim", None), ("ALASKA", None, "delim", None), ("OHIO", "ADAMS", "json", "no")],
                                     "state string, county_name string, type string, build string")
    existing = spark.createDataFrame([("OHIO", "WAYNE"), ("ALASKA", "STATEWIDE"), ("OHIO", "WYANE")], "state string, county_name string")
    assert cells(Y.stale_partitions(existing, manifest)) == [("OHIO", "WYANE")]
    assert cells(Y.to_build(manifest, "delim"), "county_name") == [("STATEWIDE",), ("WAYNE",)]
    done = spark.createDataFrame([("OHIO", "WAYNE")], "state string, county_name string")
    assert cells(Y.to_build(manifest, None, done), "county_name") == [("STATEWIDE",)]


def test_keys_from_path_and_literals(spark):
    df = spark.createDataFrame([("x/CA_Los_Angeles_long.dta",), ("MD_Baltimore_City_cvr_info.dta",), ("plain.csv",)], "p string")
    state, county = Y.keys_from_path("p")
    assert [tuple(r) for r in df.select(state, county).collect()] == [("CA", "Los_Angeles"), ("MD", "Baltimore_City"), ("pl", None)]
    more = Y.append_literals(spark.createDataFrame([("a", 1)], "s string, n int"), [{"s": "b"}])
    assert cells(more) == [("a", 1), ("b", None)]


def test_discovered_contests(spark):
    wide = spark.createDataFrame([("1", "p", "x")], "`Cvr Number` string, `Precinct Portion` string, Governor string")
    long = spark.createDataFrame([("Mayor",), ("Mayor",), ("Status",)], "Race string")
    got = discover_contests([("S", "A", "delim", wide)]).unionByName(discover_contests([("S", "B", "special", long)], "Race"))
    assert cells(got, "county_name", "contest") == [("A", "Governor"), ("B", "Mayor")]


def test_written_once_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared)
    df = written_once(spark.range(5), "ids")
    assert df.count() == 5 and shared.split("/")[-1] in df.inputFiles()[0]
