import random

from pyspark.sql import functions as F

from tallyline.llm import mixing as M

from . import cases


def targets(sizes):
    """Level by level, as the rule says it."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: M.WEIGHTS[k % 3] for k, s in enumerate(order)}
    budget, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = budget - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return share | fixed
        fixed |= {s: 2 * sizes[s] for s in over}


def rows(n=900):
    rng = random.Random(4)
    out = [(k, cases.prose(rng.choice([5, 20, 60, 200]), k), "en", rng.choice(["a", "a", "a", "a", "b", "é", "zz", None])) for k in range(n)]
    return out + [(9000 + k, cases.prose(30, k), "en", "one doc") for k in range(1)] + [(9500, "", "en", "nothing")] + cases.edges()


def check(spark, own):
    df = cases.table(spark, own)
    got = M.mix(df).collect()
    sizes = {}
    for r in own:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").encode().split())
    want = targets(sizes)
    assert sorted((r["doc_id"], r["size"], r["source_size"]) for r in got if r["doc_id"] is not None) == sorted(
        (r[0], len((r[1] or "").encode().split()), sizes[r[3]]) for r in own if r[0] is not None)
    per = {}
    for r in got:
        assert r["taken"] % max(r["size"], 1) == 0 and 0 <= r["taken"] <= 2 * r["size"]
        per.setdefault((r["source_size"], round(r["target"], 3)), []).append(r["taken"])
    assert sorted(per) == sorted({(sizes[s], round(t, 3)) for s, t in want.items()})
    return {k: sum(v) for k, v in per.items()}, got, df


def test_targets_and_taken(spark):
    taken, got, df = check(spark, rows())
    for (size, target), words in taken.items():
        if size > 3000 and size < 60_000:
            assert abs(words - target) <= 0.02 * target
    again = M.mix(df.repartition(7)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_rows_are_taken_as_the_query_says(spark):
    df = cases.table(spark, rows(200))
    words = M.mix(df).agg(F.sum("taken")).head()[0]
    out = M.apply_mix(df)
    assert out.columns == [*df.columns, "copy_1"]
    assert out.select(M.word_count(F.col("text")).alias("n")).agg(F.sum("n")).head()[0] == words


def test_edges(spark):
    check(spark, cases.edges())
    assert M.mix(cases.empty(spark)).count() == 0 and M.apply_mix(cases.empty(spark)).count() == 0
    nothing = cases.table(spark, [(1, "", "en", "a"), (2, None, "en", None)])
    assert {(r["size"], r["target"], r["taken"]) for r in M.mix(nothing).collect()} == {(0, 0.0, 0)}


def test_no_python_in_the_plan(spark):
    plan = M.apply_mix(cases.table(spark, rows(50)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
