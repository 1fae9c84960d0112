"""Tasks are cut by files and bytes: none writes all files of a folder, none sorts a whole table."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyline.catalog import files
from tallyline.catalog.base import QUERIES
from tallyline.plans import cleaning as K
from tallyline.session import TASK_SIZES, bound_tasks
from tallyline.sources import nested as M


@pytest.fixture
def suppliers(spark, tmp_path):
    rows = [(k, f"Supplier {k}", k % 25, 1.0) for k in range(410)]
    spark.createDataFrame(rows, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/in/supplier.parquet")
    return f"{tmp_path}/in"


@pytest.mark.parametrize("name", ["xml_ballots", "xml_ballot_numbers"])
def test_ballot_files_are_written_by_several_tasks(spark, suppliers, tmp_path, monkeypatch, name):
    written = tmp_path / "xml"
    monkeypatch.setattr(files, "scratch_path", lambda *_: str(written))
    made = QUERIES[name](spark, suppliers)
    parts = [p for p in Path(written).rglob("part-*")]
    assert len({p.parent for p in parts}) == len(parts) == 410  # a file per ballot
    by_task = Counter(p.name.split("-")[1] for p in parts)
    assert len(by_task) > 1 and max(by_task.values()) < 410
    if name == "xml_ballot_numbers":
        assert [tuple(r) for r in made.orderBy("ballot").collect()] == [(k, k + 1) for k in range(410)]


def test_xml_files_are_opened_once(spark, tmp_path):
    text = "<CastVoteRecord><Contests><Contest><Name>Gov</Name><Options><Option><Name>Ann</Name></Option></Options></Contest></Contests></CastVoteRecord>"
    for k in range(3):
        (tmp_path / f"{k}.xml").write_text(text)
    made = M.read_xml_ballots(spark, str(tmp_path))
    assert "Scan xml" not in made._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["cvr_id"] for r in made.collect()) == [1, 2, 3]


def test_queries_bound_tasks_where_the_session_does_not(spark):
    session = spark.newSession()
    chosen, left = list(TASK_SIZES)
    session.conf.set(chosen, "99m")
    assert session.conf.get(left, None) is None
    entry._with_bounded_tasks(lambda s, _: s.range(1))(session, "")
    assert session.conf.get(left) == TASK_SIZES[left] and session.conf.get(chosen) == "99m"
    bound_tasks(session)
    assert session.conf.get(chosen) == "99m"


@pytest.mark.parametrize("clean,columns", [
    (K.clean_race_export, ("cid", "Precinct", "Race", "Candidate")),
    (K.clean_vote_flags, ("CVRNumber", "Contest", "Candidate", "IsVote")),
    (K.clean_stacked_export, ("cvrNumber", "precinct", "contest", "candidate")),
])
def test_a_contest_is_not_gathered_by_the_lookup(spark, clean, columns):
    contests = [("OHIO", "WAYNE", f"Judge {k}", "JUDGE", "1", None, None, "1") for k in range(5)]
    lookup = spark.createDataFrame(contests, "state string, county_name string, contest string, office string, district string, candidate string, party_detailed string, magnitude string")
    raw = spark.range(20).select(*[F.concat(F.lit("Judge "), (F.col("id") % 5).cast("string")).alias(c) if c.lower() in ("race", "contest") else F.col("id").cast("string").alias(c) for c in columns])
    plan = clean(raw, "OHIO", "WAYNE", lookup)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
