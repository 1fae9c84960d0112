import hashlib
from collections import Counter

import pytest

from tallyline.llm import substring_dedup as D
from tallyline.llm.substring_dedup import remove_repeats

from . import cases


def brute(rows, window):
    split = [(r[0], (r[1] or "").encode().split()) for r in rows]
    seen = Counter(tuple(w[i : i + window]) for _, w in split for i in range(len(w) - window + 1))
    out = []
    for doc_id, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [35, 6, 1])
def test_matches_brute_force(spark, window):
    shared, other = cases.prose(50, 11), cases.prose(34, 12)
    rows = cases.edges()[:10] + [cases.edges()[-1]]
    rows += [(100 + k, f"{cases.prose(k, k)} {shared} {cases.prose(5, 200 + k)}", "en", "a") for k in range(25)]
    rows += [(200, other + " q", "en", "a"), (201, "p " + other, "en", "a"), (202, f"{shared} {shared}", "en", "a"), (203, "z " * 120, "en", "a")]
    got = sorted((tuple(r) for r in remove_repeats(cases.table(spark, rows), window).collect()), key=str)
    assert got == brute(rows, window)


def test_long_texts_and_empty_tables(spark):
    rows = [r for r in cases.edges() if r[0] in (9, 10)] + [(11, cases.prose(60_000, 2), "en", "a")]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in remove_repeats(cases.table(spark, rows)).collect()}
    assert got == {9: (60_000, 60_000), 10: (1, 0), 11: (60_000, 60_000)}
    assert remove_repeats(cases.empty(spark)).count() == 0


def test_sizes_stay_within_limits():
    for total in (0, 1, 10**9, 3 * 10**12, 10**14, 10**15):
        chunks, buckets, tasks = D.sizes(total)
        assert 1 <= tasks <= 100_000
        assert chunks * buckets <= max(1, total / 6) or total < 2**20  # several hashes an array
    assert D.sizes(10**12) == (-(-(10**12) // D.CHUNK_BYTES), -(-(10**12) // D.BUCKET_BYTES), -(-(10**12) // D.TASK_BYTES))


def test_beyond_the_limit_of_buckets(spark, monkeypatch):
    for name, value in (("MOST_BUCKETS", 3), ("TASK_BYTES", 64), ("CHUNK_BYTES", 512), ("BUCKET_BYTES", 1024), ("GROWS_FROM", 4096)):
        monkeypatch.setattr(D, name, value)
    shared = cases.prose(50, 11)
    rows = [(k, f"{cases.prose(k, k)} {shared} {cases.prose(5, 200 + k)}", "en", "a") for k in range(25)]
    got = remove_repeats(cases.table(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 35)
