"""Precinct labels and the pruned match against all pairs."""

import random

import numpy as np
import pytest
from distances import osa
from pyspark.sql import functions as F

from tallyline.plans import crosswalk as X
from tallyline.rules.precincts import BALLOT_LABELS, RETURNS_LABELS

SIDE = "state string, county_name string, label string, office string, district string, party string, n long, precincts array<string>"


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        before, row = row, [i]
        for j, cb in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (ca != cb)))
    return row[-1]


def all_pairs(left, right, distance):
    """Direct restatement: score every pair that shares a contest, then apply the rules."""
    x, y = {}, {}
    for rows, into in ((left, x), (right, y)):
        for s, c, label, *contest, n, _ in rows:
            into.setdefault((s, c, label), {})[tuple(contest)] = n
    kept = []
    for (s, c, a), va in x.items():
        scored = []
        for (s2, c2, b), vb in y.items():
            shared = va.keys() & vb.keys()
            if (s, c) == (s2, c2) and shared:
                scored.append([s, c, a, b, sum(abs(va[k] - vb[k]) for k in shared), distance(a.upper(), b.upper())])
        if any(p[5] == 0 for p in scored):
            kept += [p for p in scored if p[5] == 0]
        elif scored:
            least = min(p[4] + p[5] for p in scored)
            kept += [p for p in scored if p[4] + p[5] == least]
    least = {}
    for p in kept:
        key = (p[0], p[1], p[3])
        least[key] = min(least.get(key, p[4]), p[4])
    result = []
    for s, c, a, b, d, e in kept:
        beaten = d != least[(s, c, b)] and e != 0
        result.append((s, c, a, None if beaten else b, None if beaten else d, None if beaten else e))
    return sorted(result, key=str)


@pytest.mark.parametrize("method, distance", [("osa", osa), ("levenshtein", lev)])
@pytest.mark.parametrize("seed", [1, 2])
def test_pruned_match_equals_all_pairs(spark, method, distance, seed):
    rng = random.Random(seed)

    def side(prefix):
        rows = []
        for county in ("A", "B", "C"):
            for k in range(rng.randint(1, 14)):
                label = rng.choice([f"Ward {k}", f"WARD {k}", f"{prefix} {k}", f"Wrad {k}", f"{prefix}{k * 11}"])
                scale = rng.choice([3, 40, 900])
                for office in ("P", "S", "H"):
                    for party in ("DEMOCRAT", "REPUBLICAN"):
                        if rng.random() < 0.7:
                            rows.append(("S", county, label, office, "1", party, rng.randint(0, scale), [label]))
        unique = {r[:6]: r for r in rows}
        return list(unique.values())

    left, right = side("Pct"), side("Precinct")
    got = X.match_precincts(spark.createDataFrame(left, SIDE), spark.createDataFrame(right, SIDE), method)
    rows = got.select("state", "county_name", "label_cvr", "label_returns", "discrepancy", "name_ed_dist").collect()
    assert sorted(map(tuple, rows), key=str) == all_pairs(left, right, distance)


def like_sized(labels):
    """A county whose labels all have about as many votes in every contest; a fifth of the ballots' are miscounted."""
    rng = np.random.default_rng(5)
    contests = [("S", "C", office, "1", party) for office in "PSHGL" for party in ("DEMOCRAT", "REPUBLICAN")]
    votes = rng.integers(900, 1100, (labels, len(contests)))
    seen = votes + rng.integers(-6, 7, votes.shape) * (rng.random((labels, 1)) < 0.2)
    rows = lambda name, counts: [
        (s, c, f"{name} {k}", office, district, party, int(n), [f"{name} {k}"])
        for k, row in enumerate(counts) for (s, c, office, district, party), n in zip(contests, row)
        if not (k % 50 == 7 and office == "L")  # some lack a contest
    ]
    return rows("Pct", seen), rows("Precinct No", votes[rng.permutation(labels)])


def test_labels_of_like_size_score_few_pairs(spark):
    labels = 400
    left, right = like_sized(labels)
    x, y = (spark.createDataFrame(rows, SIDE) for rows in (left, right))
    got = X.match_precincts(x, y).select("state", "county_name", "label_cvr", "label_returns", "discrepancy", "name_ed_dist").collect()
    assert sorted(map(tuple, got), key=str) == all_pairs(left, right, osa)
    key = ["state", "county_name"]
    scored = X._near_pairs(
        x.select(*key, F.col("label").alias("x"), *X.CONTEST, "n"), y.select(*key, F.col("label").alias("y"), *X.CONTEST, F.col("n").alias("v")), "osa"
    ).count()
    assert labels <= scored < 4 * labels  # of 160,000


@pytest.mark.parametrize("state, county, label, expected", [
    ("COLORADO", "MOFFAT", "123 - (4567 x)", "4567"),          # listed twice: the first entry wins
    ("COLORADO", "MESA", "123 - x", "123"),
    ("COLORADO", "BOULDER", "2171234567 (x)", "2171234567"),
    ("GEORGIA", "COLUMBIA", "061-HBLX", "HBL"),
    ("GEORGIA", "EARLY", "001-DU x", "AU"),
    ("GEORGIA", "FULTON", "x-01A", "01A"),
    ("OREGON", "YAMHILL", "007 x", "7"),
    ("TEXAS", "SMITH", "00012 x", "012"),
    ("TEXAS", "SMITH", "none", None),
    ("MARYLAND", "PRINCE GEORGE'S", "01-001", "1-001"),
    ("NEW JERSEY", "GLOUCESTER", "TOWNSHIP OF DEPTFORD DISTRICT 4", "DEPTFORD"),
    ("NEW JERSEY", "PASSAIC", "Totowa boro boro - 1 x", "Totowa boro"),
    ("VERMONT", "ADDISON", "as is", "as is"),
])
def test_ballot_label_rules(spark, state, county, label, expected):
    df = spark.createDataFrame([(state, county, label)], "s string, c string, l string")
    assert df.select(X.label_rules("s", "c", "l", BALLOT_LABELS)).head()[0] == expected


def test_returns_label_rules(spark):
    rows = [("CALIFORNIA", "KERN", "060290123_x_y", "0123"), ("ANY", "ASHTABULA", "PRECINCT 4", "4"), ("TEXAS", "FORT BEND", "x 1234", "1234")]
    df = spark.createDataFrame(rows, "s string, c string, l string, e string")
    assert all(r[0] == r[1] for r in df.select(X.label_rules("s", "c", "l", RETURNS_LABELS), "e").collect())


def test_sides_fold_labels_and_drop_double_totals(spark):
    ballots = spark.createDataFrame(
        [("S", "C", "p1", "US PRESIDENT", "FEDERAL", "DEMOCRAT")] * 3 + [("S", "C", "p1x", "US PRESIDENT", "FEDERAL", "GREEN")],
        "state string, county_name string, precinct string, office string, district string, party_detailed string",
    )
    got = X.ballot_votes(ballots, F.upper(F.substring("precinct", 1, 2)))
    assert [tuple(r) for r in got.select("label", "district", "n", "precincts").collect()] == [("P1", "STATEWIDE", 3, ["p1"])]
    returns = spark.createDataFrame(
        [("S", "C", "a", "O", "1", "DEMOCRAT", m, v) for m, v in (("TOTAL", 9), ("MAIL", 4), ("DAY", 5))] + [("S", "C", "b", "O", "1", "DEMOCRAT", "TOTAL", 2)],
        "state string, county_name string, precinct string, office string, district string, party_simplified string, mode string, votes int",
    )
    assert sorted(tuple(r) for r in X.returns_votes(returns, F.col("precinct")).select("label", "n").collect()) == [("a", 9), ("b", 2)]
