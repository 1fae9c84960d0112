"""Joins, groups, ranks and reshaping on small literal tables."""

import random
import statistics

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyline.operators import columns as P
from tallyline.operators import groups as G
from tallyline.operators import joins as J
from tallyline.operators import reshape as S


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_checked_join_names_the_offending_key(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y")], "k int, r string")
    with pytest.raises(PySparkException, match=r'right key repeats: \{"k":1\}'):
        J.checked_join(left, right, ["k"]).collect()
    assert J.checked_join(left, right, ["k"], "left", "many-to-many").count() == 4
    with pytest.raises(PySparkException, match="left key"):
        J.checked_join(left, right.limit(1), ["k"], "left", "one-to-one").collect()


def test_many_to_one_join_keeps_row_count(spark):
    left = spark.range(100).withColumn("k", F.col("id") % 7)
    right = spark.range(5).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    assert J.checked_join(left, right, ["k"]).count() == 100


@pytest.mark.parametrize("how, expected", [
    ("inner", [(None, 1, 9)]), ("left", [("a", 2, None), (None, 1, 9)]), ("full", [("a", 2, None), ("b", None, 8), (None, 1, 9)]),
])
def test_null_keys_match(spark, how, expected):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, l int")
    right = spark.createDataFrame([(None, 9), ("b", 8)], "k string, r int")
    assert rows(J.join_null_safe(left, right, ["k"], how), "k", "l", "r") == sorted(expected, key=str)


def test_alias_clash_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "`Precinct Id` int, `PRECINCT CODE` int")
    with pytest.raises(ValueError):
        P.rename_aliases(df, "precinct", ["Precinct Id", "PRECINCT CODE"])


def test_stack_sides_equals_full_join_chain(spark):
    rng = random.Random(3)
    sides = {
        s: spark.createDataFrame(
            [(k, rng.randint(1, 9)) for k in rng.sample(["a", "b", "c", "d", None], 3)], "k string, n int"
        )
        for s in "hmv"
    }
    got = rows(J.stack_sides(["k"], **sides), "k", "n_h", "n_m", "n_v")
    tables = {s: {r["k"]: r["n"] for r in df.collect()} for s, df in sides.items()}
    keys = {k for t in tables.values() for k in t}
    assert got == sorted(((k, *[tables[s].get(k) for s in "hmv"]) for k in keys), key=str)


def test_pair_differences_equal_all_pairs(spark):
    rng = random.Random(5)
    left = [(rng.choice("ab"), rng.randint(0, 20)) for _ in range(60)]
    right = [(rng.choice("abc"), rng.randint(0, 20)) for _ in range(40)]
    make = lambda data: spark.createDataFrame(data, "k string, x long")
    got = rows(J.pair_differences(make(left), make(right), ["k"], "x"), "k", "n_pairs", "discrepancy")
    expected = []
    for key in "ab":
        pairs = [(a, b) for k, a in left if k == key for j, b in right if j == key]
        expected.append((key, len(pairs), sum(abs(a - b) for a, b in pairs)))
    assert got == expected


def test_drop_around_reaches_one_back_and_two_ahead(spark):
    df = spark.range(1, 12).withColumnRenamed("id", "idx")
    marks = spark.createDataFrame([(5,)], "idx long")
    assert [r[0] for r in sorted(J.drop_around(df, "idx", marks).collect())] == [1, 2, 3, 8, 9, 10, 11]


def test_first_per_key_takes_the_first_row_whole(spark):
    df = spark.createDataFrame([("a", 2, "later"), ("a", 1, "first"), (None, 5, "null key")], "k string, i int, v string")
    assert rows(G.first_per_key(df, ["k"], ["i"]), "k", "i", "v") == [("a", 1, "first"), (None, 5, "null key")]


MODES = [("A", "TOTAL", 1), ("A", "MAIL", 2), ("B", "MAIL", 3), ("B", "EARLY", 4), ("C", "TOTAL", 5), ("D", None, 6), ("D", "TOTAL", 7)]


@pytest.mark.parametrize("bounded", [False, True])
@pytest.mark.parametrize("rule, kept", [
    ("drop_parts", [1, 3, 4, 5, 6, 7]), ("keep_parts", [2, 3, 4, 5]), ("total_only", [1, 3, 4, 5, 7]), ("drop_mixed", [3, 4, 5, 6, 7]),
])
def test_mode_rules(spark, rule, kept, bounded):
    df = spark.createDataFrame(MODES, "k string, mode string, v int")
    got = G.filter_modes(df, ["k"], rule, bounded=bounded)
    assert sorted(r["v"] for r in got.collect()) == kept


def test_dense_ids_are_dense_and_stable(spark):
    df = spark.range(1000).select((F.col("id") % 37).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("b"))
    ids = G.dense_ids(df, ["a", "b"], buckets=8)
    n = df.distinct().count()
    assert sorted(r["id"] for r in ids.collect()) == list(range(1, n + 1))
    again = G.dense_ids(df.repartition(13), ["a", "b"], buckets=8)
    assert rows(ids, "a", "b", "id") == rows(again, "a", "b", "id")
    assert G.attach_ids(df, ["a", "b"]).count() == 1000


@pytest.mark.parametrize("seed", range(6))
def test_summary_matches_direct_statistics(spark, seed):
    rng = random.Random(seed)
    n = rng.choice([1, 2, 7, 100, 301])
    hot = rng.choice([0.0, 0.4])
    values = [None if rng.random() < 0.1 else 5.0 if rng.random() < hot else rng.uniform(-50, 1e4) for _ in range(n)]
    values[0] = 3.25
    weights = [rng.randint(1, 9) for _ in range(n)]
    df = spark.createDataFrame(list(zip(values, weights)), "x double, w long")
    row = G.variable_summary(df, ["x"], "w", accuracy=rng.choice([10, 1000, 100_000])).head()
    known = [(v, w) for v, w in zip(values, weights) if v is not None]
    xs = [v for v, _ in known]
    assert row["Median"] == pytest.approx(statistics.median(xs))
    assert row["Mean"] == pytest.approx(statistics.fmean(xs))
    assert row["Total"] == pytest.approx(sum(v * w for v, w in known) / sum(w for _, w in known))
    if len(xs) > 1:
        assert row["SD"] == pytest.approx(statistics.stdev(xs))


def test_histogram_shares_and_row_rates(spark):
    df = spark.createDataFrame([(0.0009,), (0.0011,), (-0.0001,), (None,)], "x double")
    got = rows(G.width_histogram(df, "x", 0.002), "bin", "n")
    assert got == [(-1, 1), (0, 2)]
    wide = spark.createDataFrame([(0, 0, None), (0, 5, 1), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in wide.select(G.row_match_rate(["a", "b", "c"], 0)).collect()] == [1.0, pytest.approx(1 / 3), None]
    assert [r[0] for r in wide.select(G.row_sum("a", "b", "c")).collect()] == [0, 6, 0]


def test_crosstab_margins_keep_real_nulls_apart(spark):
    df = spark.createDataFrame([("a", "x"), (None, "x")], "p string, q string")
    assert rows(G.crosstab_margins(df, "p", "q"), "p", "q", "n") == sorted(
        [("a", "x", 1), (None, "x", 1), ("Sum", "x", 2), ("a", "Sum", 1), (None, "Sum", 1), ("Sum", "Sum", 2)], key=str
    )


def test_reshape_round_trip(spark):
    df = spark.createDataFrame([(1, "1", None), (2, "0", "1")], "id int, `A, b` string, c string")
    long = S.to_long(df, ["id"], "contest", "cell")
    assert rows(long, "id", "contest", "cell") == [(1, "A, b", "1"), (2, "A, b", "0"), (2, "c", "1")]
    wide = S.to_wide(long, ["id"], "contest", ["c", "zz"], {"n": F.count(F.lit(1)), "v": F.max("cell")})
    assert wide.columns == ["id", "c_n", "c_v", "zz_n", "zz_v"]
    lists = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, l array<string>")
    assert S.unnest(lists, "l").count() == 2
    nested = spark.createDataFrame([(("x", ["p", "q"]),)], "s struct<a:string,b:array<string>>")
    assert S.hoist(nested, "s", {"a": ["a"], "b2": ["b", 2], "b9": ["b", 9]}).select("a", "b2", "b9").head() == ("x", "q", None)


def test_metadata_merges(spark):
    own = spark.createDataFrame([("k1", "OWN"), ("k2", None), ("k3", "OWN")], "k string, p string")
    meta = spark.createDataFrame([("k1", "META", None), ("k2", "META", None), ("k3", "META", "dup")], "k string, p string, issue string")
    assert rows(J.metadata_wins(own, meta, ["k"], "p"), "k", "p") == [("k1", "META"), ("k2", "META")]
    assert rows(J.fill(own, meta.drop("issue"), ["k"], "p"), "k", "p") == [("k1", "OWN"), ("k2", "META"), ("k3", "OWN")]


def test_remap_ids_is_driven_by_the_list(spark):
    records = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "cvr_id long, item string")
    info = spark.createDataFrame([(1, 10), (2, None), (9, 90), (None, 7)], "cvr_id long, merged long")
    assert rows(J.remap_ids(records, info, "cvr_id", "merged", ["item"]), "cvr_id", "item") == [(10, "a"), (2, "b")]
