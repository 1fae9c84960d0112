"""Split-row pairing against a direct restatement of the row-by-row rule."""

import random

import pytest

from tallyline.operators.pairing import pair_rows_ranked, pair_split_rows

SCHEMA = "idx long, grp string, target string, other string"


def spiral(i, n):
    """Step ahead, step back, two ahead, two back; ends when ahead leaves the file."""
    step = 1
    while i + step < n:
        yield i + step
        if i - step >= 0:
            yield i - step
        step += 1


def brute_force(rows):
    """rows: list of [idx, grp, target, other]; returns the surviving merged rows."""
    data, used, n = [list(r) for r in rows], set(), len(rows)
    for i in range(n):
        if i in used or data[i][2] is not None:
            continue
        for j in spiral(i, n):
            same = data[i][1] is not None and data[i][1] == data[j][1]
            if j not in used and same and data[j][2] is not None:
                data[i] = [data[i][0]] + [a if a is not None else b for a, b in zip(data[i][1:], data[j][1:])]
                used.add(j)
                break
    return sorted(tuple(r) for k, r in enumerate(data) if k not in used)


def run(spark, rows, stretch):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in pair_split_rows(df, "idx", "grp", "target", stretch=stretch).collect())


def test_neighbour_backward_chain_and_null_group(spark):
    rows = [
        (1, "A", None, "p2"), (2, "A", "x", None),      # forward neighbour
        (3, "B", "y", None), (4, "A", None, "q2"),      # backward, forward is another group
        (5, "B", None, "r2"), (6, "B", None, "r3"),     # three pages end in one row
        (7, None, None, "s"), (8, "C", None, "t"),      # null group; end of file
    ]
    assert run(spark, rows, 1 << 16) == brute_force(rows)


@pytest.mark.parametrize("stretch", [2, 5, 1 << 16])
def test_random_files_match_brute_force(spark, stretch):
    rng = random.Random(stretch)
    rows, expected = [], []
    for f in range(60):
        n, missing, groups = rng.randint(1, 40), rng.choice([0.2, 0.5, 0.7]), rng.choice([1, 2, 3])
        file_rows = [
            (
                k + 1,
                rng.choice([None, "a", "b", "c"][: groups + 1][-groups:] + (["a"] if groups else [])),
                None if rng.random() < missing else f"t{k}",
                rng.choice([None, f"o{k}"]),
            )
            for k in range(n)
        ]
        rows += [(f"f{f}", *r) for r in file_rows]
        expected += [(f"f{f}", *r) for r in brute_force(file_rows)]
    df = spark.createDataFrame(rows, "file string, " + SCHEMA)
    got = pair_split_rows(df, "idx", "grp", "target", scope=["file"], stretch=stretch).collect()
    key = lambda r: tuple(str(v) for v in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(expected, key=key)


def test_regular_spacing_keeps_its_regime_across_stretches(spark):
    # a complete row with its page behind at distance one, next pair two further on
    rows = []
    for k in range(60):
        rows += [(3 * k + 1, "g", f"t{k}", None), (3 * k + 2, "g", None, f"o{k}"), (3 * k + 3, "h", f"u{k}", None)]
    assert run(spark, rows, 7) == brute_force(rows)


def test_bracket_suffix_is_ignored(spark):
    rows = [(1, "S 4 [2]", None, "p2"), (2, "S 4", "x", None), (3, "S 5", "z", None)]
    assert run(spark, rows, 16) == [(1, "S 4", "x", "p2"), (3, "S 5", "z", None)]


def test_ranked_variant(spark):
    rows = [(1, "A", None, ""), (2, "A", "x", ""), (3, "A", None, "")]
    got = pair_rows_ranked(spark.createDataFrame(rows, SCHEMA), "idx", "grp", "target")
    assert sorted(map(tuple, got.collect())) == [("A", 1, 1, 2), ("A", 2, 3, None)]


def test_stretches_are_read_across_arrow_batches(spark):
    rng = random.Random(5)
    rows = [(k + 1, rng.choice("abcdefgh"), None if rng.random() < 0.4 else f"t{k}", f"o{k}") for k in range(200)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        assert run(spark, rows, 16) == brute_force(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_small_groups_share_a_python_call(spark):
    # a call per stretch of a group cost more than its rows: 6 million events are some 100,000 stretches
    rows = spark.createDataFrame([(1, "A", None, "p"), (2, "A", "x", None)], SCHEMA)
    plan = pair_split_rows(rows, "idx", "grp", "target")._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "FlatMap" not in plan
