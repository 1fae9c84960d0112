import random

import pytest
import tiktoken
from pyspark.sql import functions as F

from tallyline.llm import token_counts as T

from . import cases


@pytest.fixture(scope="module")
def ranks():
    return T.read_ranks()


@pytest.fixture(scope="module")
def whole(ranks):
    return tiktoken.Encoding("whole", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_edited_trees_equal_a_full_count(ranks, whole):
    count, rng = T.counter(ranks), random.Random(1)
    alphabet = "ab c'  \n\t1é,.s"
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 900)))
        tree = T.build(text, count)
        assert tree.tokens[1] == len(whole.encode_ordinary(text)) and tree.chars[1] == len(text)
        for _ in range(4):
            s = rng.randint(0, len(text))
            e = min(len(text), s + rng.choice([0, 0, 1, 3, 300]))
            text, _ = T.edit(text, tree, s, e, "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 2, 40]))), count)
            assert tree.tokens[1] == len(whole.encode_ordinary(text)) and tree.chars[1] == len(text)


def test_an_edit_touches_little(ranks):
    count, text = T.counter(ranks), cases.prose(20_000, 1)
    tree = T.build(text, count)
    _, again = T.edit(text, tree, 50_000, 50_003, "new", count)
    assert again < 1000


def test_query_columns_match_brute_force(spark, whole):
    rows = cases.edges()
    got = T.count_tokens(cases.table(spark, rows), T.sample_edits(F.col("text"))).collect()
    want = []
    for doc_id, text, *_ in rows:
        text, n = text or "", len(text or "")
        new = text[: n // 2] + " put in: 42 words" + text[n // 2 :]
        if n >= 100:
            new = text[: n // 4] + "Edited 1 " + text[n // 4 + 5 : n // 2] + " put in: 42 words" + text[n // 2 : n * 3 // 4] + text[n * 3 // 4 + 20 :]
        want.append((doc_id, len(whole.encode_ordinary(text)), len(whole.encode_ordinary(new)), len(new)))
    assert sorted(((r["doc_id"], r["n_tokens"], r["n_tokens_edited"], r["n_chars_edited"]) for r in got), key=str) == sorted(want, key=str)
    assert T.count_tokens(cases.empty(spark)).count() == 0
