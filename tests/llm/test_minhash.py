import random
from itertools import combinations

import numpy as np

from tallyline.llm import minhash

from . import cases


def brute(rows, size=5, percent=85):
    sets = []
    for r in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "").encode().split()
        sets.append({tuple(w[k : k + size]) for k in range(max(len(w) - size + 1, 1))} if w else set())
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
            up[root(a)] = root(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[root(k)] = min(least.get(root(k), r[0]), r[0])
    return sorted(((r[0], len(s), least.get(root(k)), r[0] is not None and r[0] == least.get(root(k))) for k, (r, s) in enumerate(zip(rows, sets))), key=str)


def found(spark, rows):
    out = minhash.minhash_copies(cases.table(spark, rows))
    return sorted((tuple(r) for r in out.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def family(n, first, changes, seed=1, length=120):
    base, rng, rows = cases.words(length, seed), random.Random(seed), []
    for k in range(n):
        own = list(base)
        for _ in range(rng.randint(*changes)):
            own[rng.randrange(length)] = f"w{rng.randrange(10 ** 6)}"
        rows.append((first + k, " ".join(own).title() if k % 5 == 0 else " ".join(own), "en", "a"))
    return rows


def test_edges(spark):
    rows = [r for r in cases.edges() if len(r[1] or "") < 400_000] + [(20, "ONE", None, None), (21, "one two", None, None), (22, "One  Two", None, None)]
    assert found(spark, rows) == brute(rows)
    assert minhash.minhash_copies(cases.empty(spark)).collect() == []


def test_groups_near_the_threshold(spark):
    rows = family(90, 100, (0, 5)) + family(40, 300, (3, 6), seed=2) + [(500 + k, cases.prose(60, 500 + k), "en", "a") for k in range(40)]
    rows += [(700 + k, rows[k % 7][1], "en", "a") for k in range(60)]
    assert found(spark, rows) == brute(rows)


def test_unlinked_texts_that_share_most_of_a_page(spark):
    page = cases.words(40, 9)
    rows = [(k, " ".join([*page[:20], f"a{k}", f"b{k}", *page[20:]]), "en", "a") for k in range(150)]
    assert found(spark, rows) == brute(rows)


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    assert (minhash.sketches(rng.integers(0, 2**63, 3).astype(np.uint64), np.array([1, 2, 0]))[:2] != ~np.uint64(0)).all()
    apart = []
    for k in range(60):
        a = rng.integers(0, 2**63, 220).astype(np.uint64)
        b = np.concatenate([a[:200], rng.integers(0, 2**63, 20).astype(np.uint64)])
        one, two = minhash.sketches(np.concatenate([a, b]), np.array([220, 220]))
        apart.append((one == two).mean() - 200 / 240)
    assert abs(np.mean(apart)) < 0.02 and np.std(apart) < 0.035


def test_short_sketch_keeps_the_bound():
    assert minhash.AGREE <= 0.85 * minhash.COORDINATES - 6 * (minhash.COORDINATES * 0.85 * 0.15) ** 0.5 + 5


def test_filter_of_wanted_texts_loses_none(spark):
    from pyspark.sql import functions as F

    rows = spark.range(20000).select(F.when(F.col("id") != 7, F.col("id")).alias("id"), (F.col("id") % 50).alias("of"))
    wanted = rows.where("id % 10 = 3 OR id IS NULL").coalesce(2)
    held = rows.where(minhash._may_be_wanted(wanted, "id", "of"))
    assert wanted.exceptAll(held).isEmpty() and held.count() < 2001 + 0.2 * 18000
    # a table too small for its rows only lets more pass
    crowded = rows.where(minhash._may_be_wanted(wanted, "id", "of", most=8))
    assert wanted.exceptAll(crowded).isEmpty()
    assert rows.where(minhash._may_be_wanted(wanted.where("false"), "id", "of")).isEmpty()
