import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyline.llm import spelling
from tallyline.llm.base import Scratch

from . import cases


def spoken(rows):
    count = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def grouped(words):
    near = {w: [v for v in words if v != w and one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), words[w], len(near[w]), words[form[w]] if form[w] else None) for w in words)


def as_rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def variants(seed, n):
    """Words around few stems, with counts that make chains of forms."""
    rng, out = random.Random(seed), {}
    for k in range(n):
        word = rng.choice(["balance", "ballade", "éclairs", "eclairs", "aaabbb", "aabbbb", "straße", "naïveté"])
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word))
            word = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice("abeéïßÿ") + word[at:], word[:at] + rng.choice("abeéÿ") + word[at + 1 :]])
        if len(word) >= 6:
            out[word] = 5 ** rng.randint(1, 5)
    return out


def test_documents_with_edges(spark):
    own = variants(1, 60)
    rows = cases.edges() + [(100 + k, " ".join([w.upper() if w.isascii() else w] * 40), "en", "a") for k, w in enumerate(own)]
    rows += [(200 + k, " ".join(w for w in own for _ in range(k % 7)), "en", "a") for k in range(20)]
    assert as_rows(spelling.spelling_variants(cases.table(spark, rows))) == grouped(spoken(rows))
    assert spelling.spelling_variants(cases.empty(spark)).collect() == []


@pytest.mark.parametrize("budget", [1024, 1 << 20])
def test_ties_chains_and_sliced_filters(spark, budget):
    words = variants(2, 250)
    with Scratch(spark) as scratch:
        df = scratch.write(spark.createDataFrame(list(words.items()), "word string, n long"), "words")
        out = as_rows(spelling.group_variants(df, scratch, budget))
    assert out == grouped(words)
    assert any(r[2] != r[1] and r[1] for r in out) and any(r[4] > 1 for r in out)


def test_a_pass_stays_within_its_budget():
    plan = spelling.plan_shards({6: 10_000, 7: 3, 9: 500_000}, 1 << 16)
    assert len(plan) > 10 and all(sum(blocks * spelling.CELLS * 8 for _, blocks in own.values()) <= 1 << 16 for own in plan)
    assert {key for own in plan for key in own} >= {(6, 0), (7, 0), (9, 0)}


def test_filters_rarely_answer_for_other_words():
    rng = np.random.default_rng(3)
    words, others = [np.unique(rng.integers(97, 123, (20_000, 8)).astype(np.uint8), axis=0) for _ in range(2)]
    blocks = spelling.plan_shards({8: len(words)})[0][(8, 0)][1]
    cells = np.zeros(blocks * spelling.CELLS, np.uint64)
    block, probes = spelling.bloom_place(spelling.word_hash(words), blocks)
    for cell, bit in probes:
        np.bitwise_or.at(cells, block * spelling.CELLS + cell.astype(np.int64), np.uint64(1) << bit)
    held = spelling.Filters({(8, 0): (1, cells)})
    assert held.maybe(spelling.word_hash(words), 8).all()
    assert held.maybe(spelling.word_hash(others), 8).mean() < 0.02
