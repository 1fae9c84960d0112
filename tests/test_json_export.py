"""The JSON export: written packed, read once, and no shuffle file outlives the write it was made for."""

import gzip
import json
import random
import time
from collections import defaultdict

import duckdb
import pytest
from test_sources import export

from tallyline.catalog import files, roles
from tallyline.catalog.base import ORACLES, QUERIES
from tallyline.plans import cleaning as K
from tallyline.session import FREE_SHUFFLES, shuffles_freed
from tallyline.sources import nested as M


def blocks(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = manager.getAllBlocks()
    return {name for k in range(found.size()) if (name := found.apply(k).name()).startswith("shuffle_")}


def left_after(spark, before):
    """Shuffle blocks made since; they are removed in the background."""
    until = time.time() + 10
    while (left := blocks(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


@pytest.fixture
def tables(spark, tmp_path):
    """Ballots of 300 orders over three export files; some lines come twice, some name no order or part, some cells are null."""
    draw, folder = random.Random(7), tmp_path / "in"
    types = [*roles.OFFICE_OF_TYPE, None]
    lines = [
        (k * 17, draw.randrange(45), draw.randrange(1, 8), draw.choice([10.0, 30.0, None]), draw.choice([0.01, 0.09, None]), 0.0, draw.choice(["A", "N", "R", None]), "O")
        for k in range(320) for _ in range(draw.randrange(5))
    ]
    made = {
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "INDIA", 0), (1, "CHINA", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(k, k % 2) for k in range(60)], "c_custkey bigint, c_nationkey int"),
        "orders": ([(k * 17, k % 60) for k in range(300)], "o_orderkey bigint, o_custkey bigint"),
        "part": ([(k, f"Brand#{10 + k % 7}", types[k % 7], k) for k in range(40)], "p_partkey bigint, p_brand string, p_type string, p_size int"),
        "lineitem": (lines + lines[:50], "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_json_export_equals_its_sql(spark, tables):
    """On rows without nulls, which the SQL counts otherwise than an export that leaves them out."""
    known = f"{tables}/known"
    for name, condition in (("lineitem", "l_quantity + l_discount IS NOT NULL AND l_returnflag IS NOT NULL"), ("part", "p_type IS NOT NULL")):
        spark.read.parquet(f"{tables}/{name}.parquet").where(condition).write.parquet(f"{known}/{name}.parquet")
    for name in ("region", "nation", "customer", "orders"):
        spark.read.parquet(f"{tables}/{name}.parquet").write.parquet(f"{known}/{name}.parquet")
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "orders", "part", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{known}/{name}.parquet/*.parquet'")
    before = blocks(spark)
    made = QUERIES["json_export"](spark, known)
    assert not left_after(spark, before)
    want = con.execute(ORACLES["json_export"]).fetchall()
    assert rows(made) == sorted(want, key=str) != []


def test_voters_joined_last_give_the_same_ballots(spark, tables):
    plain, by_voter = roles.ballots(spark, tables), roles.ballots(spark, tables, by_voter=True)
    assert by_voter.columns == plain.columns and rows(by_voter) == rows(plain) != []


def test_export_is_packed_and_whole(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "scratch_path", lambda *_: str(tmp_path / "export"))
    before = blocks(spark)
    files._export_folder(spark, tables)
    assert not left_after(spark, before)
    parts = [p for p in (tmp_path / "export" / "CvrExport_1.json").rglob("part-*")]
    assert len(parts) == len({p.parent for p in parts}) == 3 and all(p.suffix == ".gz" for p in parts)
    found = []
    for part in parts:
        (document,) = gzip.decompress(part.read_bytes()).decode().splitlines()
        for s in json.loads(document)["Sessions"]:
            side = s.get("Modified") or s["Original"]
            assert side["IsCurrent"] and s["BatchId"] == s["RecordId"] // 100
            for c in side["Cards"][0]["Contests"]:
                assert c["Overvotes"] == (len(c["Marks"]) > 1) and c["Undervotes"] == (not any(m.get("IsVote") for m in c["Marks"]))
                found += [(s["RecordId"], side["PrecinctPortionId"], c.get("Id"), *(m.get(x) for x in ("CandidateId", "PartyId", "IsVote", "IsAmbiguous"))) for m in c["Marks"]]
    offices, parties = [*roles.OFFICE_OF_TYPE.values()], [*roles.PARTY_OF_FLAG.values()]
    number = lambda names, n: names.index(n) if n in names else None
    over = lambda x, least: None if x is None else x > least
    order = ["US PRESIDENT", "US SENATE", "US HOUSE", "STATE SENATE", "STATE HOUSE", "GOVERNOR"]
    assert sorted(offices) == sorted(order)
    want = {
        (r["cvr_id"], int(r["precinct"][1:]), number(order, r["office"]), int(r["candidate"][6:]), number(parties, r["party_detailed"]), over(r["qty"], 25), over(r["discount"], 0.05))
        for r in roles.ballots(spark, tables).collect()
    }
    assert sorted(found, key=str) == sorted(want, key=str)


def test_export_is_opened_once_and_frees_its_shuffles(spark, tmp_path):
    export(tmp_path)
    before = blocks(spark)
    marks = M.read_json_ballots(spark, str(tmp_path))
    assert not left_after(spark, before)
    plan = marks._jdf.queryExecution().executedPlan().toString()
    assert "Scan json" not in plan and "Exchange" not in plan
    assert marks.count() == 3


def test_shuffles_are_freed_inside_only(spark, tmp_path):
    counted = spark.range(1000).groupBy("id").count()
    kept = spark.conf.get(FREE_SHUFFLES, None)
    before = blocks(spark)
    with pytest.raises(ZeroDivisionError), shuffles_freed(spark):
        counted.write.parquet(str(tmp_path / "a"))
        1 / 0
    assert not left_after(spark, before) and spark.conf.get(FREE_SHUFFLES, None) == kept
    assert counted.count() == spark.read.parquet(str(tmp_path / "a")).count() == 1000


MARKS = "cvr_id int, contest string, precinct string, magnitude string, candidate string, party_detailed string, isVote boolean, isAmbiguous boolean, undervotes int, overvotes int"


def test_votes_and_blanks_as_restated_with_one_exchange(spark):
    draw = random.Random(3)
    marks = [
        (draw.choice([None, *range(60)]), draw.choice("AB"), draw.choice(["p", "q", None]), draw.choice(["1", "2", None]), draw.choice("XYZ"), None,
         draw.choice([True, False, False, None]), draw.choice([True, False, None]), draw.choice([0, 1, None]), draw.choice([0, 1, None]))
        for _ in range(300)
    ]
    want, contests = [], defaultdict(list)
    for m in marks:
        cvr, contest, precinct, magnitude, candidate, _, vote, ambiguous, under, over = m
        valid = False if vote is False or ambiguous is True else None if vote is None or ambiguous is None else True
        if valid:
            want.append((cvr, contest, precinct, magnitude, candidate, "VALID"))
        contests[cvr, contest].append((precinct, magnitude, valid, ambiguous, (under or 0) > 0, (over or 0) > 0))
    for group, own in contests.items():
        known = [r[2] for r in own if r[2] is not None]
        if not known or any(known):
            continue
        doubtful = [r[3] for r in own if r[4] and r[3] is not None]
        for choice in {r[:2] for r in own}:
            here = [r for r in own if r[:2] == choice]
            if any(r[4] and (r[3] is False or (doubtful and all(doubtful))) for r in here):
                want.append((*group, *choice, "UNDERVOTE", "UNDERVOTE"))
            if any(r[5] for r in here):
                want.append((*group, *choice, "OVERVOTE", "OVERVOTE"))
    got = K.vote_partition(spark.createDataFrame(marks, MARKS))
    assert rows(got.drop("party_detailed")) == sorted(want, key=str)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
