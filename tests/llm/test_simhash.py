import random
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tallyline.llm import simhash
from tallyline.llm.base import Scratch
from tallyline.llm.components import stars

from . import cases


def brute_fingerprint(text, shingle=3):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    parts = [b" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, distance=3):
    fps = [brute_fingerprint(r[1]) for r in rows]
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= distance:
            up[root(a)] = root(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[root(k)] = min(least.get(root(k), r[0]), r[0])
    return sorted(((r[0], f"{fps[k]:016x}", least.get(root(k))) for k, r in enumerate(rows)), key=str)


def near_rows():
    base = cases.words(400, 5)
    rows = []
    for k in range(60):
        own, rng = list(base), random.Random(k)
        for _ in range(k % 4):
            own[rng.randrange(len(own))] = "changed"
        rows.append((100 + k, " ".join(own).upper() if k % 7 == 0 else " ".join(own), "en", "a"))
    return rows + [(300 + k, cases.prose(30, 300 + k), "en", "a") for k in range(40)]


def test_matches_brute_force(spark):
    rows = [r for r in cases.edges() if r[0] != 9] + near_rows()
    got = sorted((tuple(r) for r in simhash.near_copies(cases.table(spark, rows)).select("doc_id", "fingerprint", "component_id").collect()), key=str)
    assert got == brute(rows)


def test_links_lose_no_pair(spark):
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(300)}
    for v in list(values):
        for flips in (1, 2, 3, 4):
            values.add(v ^ sum(1 << b for b in rng.sample(range(64), flips)))
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = {(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    got = [tuple(r) for r in simhash.links(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_thresholds_keep_the_pigeonhole():
    rng = np.random.default_rng(1)
    for parts in (2, 3, 4):
        costs = [[0.0, *np.cumsum(rng.random(4) * 10).tolist()] for _ in range(parts)]
        total, chosen = simhash.allocate(costs, 3)
        assert sum(t + 1 for t in chosen) == 4 and abs(total - sum(c[t + 1] for c, t in zip(costs, chosen))) < 1e-9


def test_one_of_each_group_stays(spark):
    rows = cases.edges()[:9] + near_rows()
    df = cases.table(spark, rows)
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns
    components = {(c, f if c is None else "") for _, f, c in brute(rows)}
    assert kept.count() == len(components)
    ids = {r["doc_id"] for r in kept.collect() if r["doc_id"] is not None}
    assert ids == {c for c, _ in components if c is not None}
    assert simhash.drop_near_copies(cases.empty(spark)).count() == 0 and simhash.near_copies(cases.empty(spark)).count() == 0


def test_components_of_chains_and_stars(spark):
    pairs = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(200, 200), (301, 300), (300, 301)]
    with Scratch(spark) as scratch:
        got = {r["node"]: r["root"] for r in stars(spark.createDataFrame(pairs, "a long, b long"), scratch).collect()}
        none = stars(spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b")), scratch).count()
    assert got == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 160)} | {300: 300, 301: 300} and none == 0
