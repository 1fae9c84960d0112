import hashlib
import random
import zlib

from pyspark.sql import functions as F

from tallyline.llm import prefix_trie
from tallyline.llm.base import Scratch

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: tuple(t[3] for t in sorted(turns, key=lambda t: t[:3])) for c, turns in own.items()}
    rebuilt = {c: own.get(c - c % 20, ())[: zlib.crc32(str(c).encode()) % 4] + seq[zlib.crc32(str(c).encode()) % 4 :] for c, seq in own.items()}
    members, ends = {}, {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    kids, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            kids[node[:-1]] = kids.get(node[:-1], 0) + 1
    for node, of in members.items():
        words = len(prefix_words(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(of) - 1) * words
    return sorted(((
        min(of), len(node), min(members[node[:-1]]) if node else None, len(of), kids.get(node, 0), leaves[node], saved[node],
        hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
    ) for node, of in members.items()), key=str)


def prefix_words(text):
    return text.encode().split()


def found(spark, rows):
    extra = {c: F.lit("x") for c in ("a", "b", "pa", "place", "n", "h", "total", "block")}
    out = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA).withColumns(extra).repartition(3))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in out.select(*columns).collect()), key=str)


def test_edges(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "bot", None]), rng.choice(["hi there", "no", "", None, "a b  c\n"])) for c in range(70) for t in range(rng.randint(0, 5))]
    rows += [(None, 1, "user", "lost"), (7, None, "user", "first"), (7, None, "user", "first"), (9, 2, "a", "bc"), (9, 2, "ab", "c"), (9, 2, None, None)]
    rows += [(41, 0, "user", "long " * 30_000), (2**60, 1, "user", "hi there"), (20, 5, "bot", "é \U0001f600")]
    assert found(spark, rows) == brute(rows)
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_many_equal_conversations_and_one_long_one(spark):
    rows = [(20 * k, t, "user", f"same {t}") for k in range(300) for t in range(3)] + [(1_000_000, t, "user", f"turn {t % 3}") for t in range(60)]
    assert found(spark, rows) == brute(rows)


def test_subtree_totals_of_chain_star_and_random_trees(spark):
    rng, n = random.Random(5), 60
    shapes = [lambda k: k - 1, lambda k: 0, rng.randrange, lambda k: max(k - 1 - rng.randrange(3), 0)]
    parent = {t * n + k: t * n + shape(k) if k else None for t, shape in enumerate(shapes) for k in range(n)}
    value = {k: rng.randrange(100) for k in parent}
    total = dict(value)
    for k in sorted(parent, reverse=True):
        if parent[k] is not None:
            total[parent[k]] += total[k]
    rows = [(k, -k, p, None if p is None else -p, value[k]) for k, p in parent.items()]
    with Scratch(spark) as scratch:
        nodes = spark.createDataFrame(rows, "a long, b long, pa long, pb long, held long")
        assert {r["a"]: r["held"] for r in prefix_trie.subtree_totals(nodes, ["held"], scratch).collect()} == total
