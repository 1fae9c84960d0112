import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tallyline.sources import delimited as D
from tallyline.sources import records as R
from tallyline.sources.delimited import FILE


@pytest.fixture
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "97b", "spark.sql.files.openCostInBytes": "1b", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cell(rng):
    return "".join(rng.choice(["a", "b", " ", ",", '"', "\n", "\r\n", "é", "x" * 9, ""]) for _ in range(rng.randint(0, 6))) + rng.choice("yz")


def write(path, rows, end):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end).writerows(rows)
    path.write_bytes(out.getvalue().encode())


def test_random_quotes_in_small_ranges(spark, tmp_path, small_ranges):
    rng, want = random.Random(7), []
    for k in range(6):
        header = ["Cvr", f"Head\nof {k % 2}", "Gov"]
        rows = [[cell(rng), cell(rng), str(n)] for n in range(rng.choice([0, 1, 40]) if k else 60)]
        write(tmp_path / f"{k}.csv", [header, *rows], rng.choice(["\n", "\r\n"]))
        want += [(f"{k}.csv", n + 1, f"Head\nof {k % 2}", *r) for n, r in enumerate(rows)]
    (tmp_path / "empty.csv").write_bytes(b"")
    index = R.block_index(spark, [str(tmp_path)])
    assert index.where(f"{FILE} LIKE '%/0.csv'").count() > 5
    got = R.read_split(spark, str(tmp_path))
    middle = [c for c in got.columns if c.startswith("Head")]
    read = [(r[FILE].rsplit("/", 1)[1], r["idx"], next((m for m in middle if r[m] is not None), None), r["Cvr"], next((r[m] for m in middle if r[m] is not None), None), r["Gov"]) for r in got.collect()]
    assert sorted((f, n, a, b, g) for f, n, _, a, b, g in read) == sorted((f, n, a, b, g) for f, n, _, a, b, g in want)


def test_same_rows_as_one_task(spark, tmp_path, small_ranges):
    rows = [[str(k), f'said "{k}"\nand left' if k % 3 else "", "x"] for k in range(80)]
    write(tmp_path / "a.csv", [["Cvr", "Note", "Gov"], *rows], "\n")
    split = R.read_split(spark, str(tmp_path)).select("idx", "Cvr", "Note", "Gov")
    whole = D.number_rows(D.read_wide_ballots(spark, str(tmp_path)), "idx").select("idx", "Cvr", "Note", "Gov")
    assert sorted(map(tuple, split.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


def test_numbers_run_on_within_a_county_and_jobs_do_not_grow_with_files(spark, tmp_path):
    for k in range(24):
        write(tmp_path / f"county{k % 3}-{k:02}.csv", [["Cvr", "Gov"], *[[f"{k}\n{n}", "x"] for n in range(k % 5)]], "\n")
    county = F.regexp_extract(FILE, r"(county\d)-", 1)

    def jobs(pattern):
        spark.sparkContext.setJobGroup(pattern, "planning")
        table = R.read_split(spark, str(tmp_path / pattern), county)
        ran = len(spark.sparkContext.statusTracker().getJobIdsForGroup(pattern))
        spark.sparkContext.setJobGroup("other", "reading")
        return table, ran

    (few, at_few), (many, at_many) = jobs("county0-0[0-6].csv"), jobs("*.csv")
    assert at_few == at_many
    got = many.select(county.alias("county"), "idx", "Cvr").orderBy("county", "idx").collect()
    for c in range(3):
        want = [f"{k}\n{n}" for k in range(24) if k % 3 == c for n in range(k % 5)]
        assert [(r["idx"], r["Cvr"]) for r in got if r["county"] == f"county{c}"] == [(n + 1, w) for n, w in enumerate(want)]


def test_open_quote_and_wide_record(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Cvr,Gov\n1,"x\n2,y\n')
    with pytest.raises(ValueError, match="stays open"):
        R.read_split(spark, str(tmp_path))
    (tmp_path / "a.csv").write_text('Cvr,Gov\n1,"x\ny",z\n\n')
    with pytest.raises(Exception, match="more than 2 cells"):
        R.read_split(spark, str(tmp_path)).collect()
    (tmp_path / "a.csv").write_text('\nCvr,Gov\n\n1\n2,"",,\n')
    assert [tuple(r) for r in R.read_split(spark, str(tmp_path)).select("idx", "Cvr", "Gov").orderBy("idx").collect()] == [(1, "1", None), (2, "2", None)]
