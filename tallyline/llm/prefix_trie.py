"""Prefix trie of conversations by parallel tree contraction (operator 11).

A node is a sequence of first turns; its key is the exclusive or of 128-bit
hashes of (place, turn) over the sequence, so keys come from running sums and
no conversation is gathered into a list.  Subtree totals come from contraction:
every round *rakes* all leaves into their parents and *compresses* unary chains
by splicing out an independent set of their nodes (heads by coin above tails),
both as joins on the node key.  What a spliced node held moves to the edge
below it.  A constant share of all nodes goes each round whatever the shape
(one chain, one star), so the rounds grow with the logarithm of the nodes.
Expansion walks the rounds backwards: a raked node knows its total, a spliced
one adds its own part to the total of the child it had.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyline.llm.base import Scratch, needed, query, table
from tallyline.shipping import by_value

by_value(__name__)

#: Conversations of one family share the first turns of the family's first one.
FAMILY, MOST_SHARED = 20, 4
#: Ids joined into one piece of text before the pieces of a node are digested in order.
PIECE_IDS = 4096

WORD = r"[^\x20\x09-\x0D]+"
_NODE = ["a", "b"]


def numbered_turns(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Turns with their place, and the turns of each block of a conversation.

    Turns are dealt by ranges of (``conv_id``, ``turn``), so a conversation of
    any length spreads over blocks (``block``); places inside a block are
    shifted by the blocks before.  Equal turn numbers follow the digest of role
    and text; null numbers come first.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = needed(conversations, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.rand(11).alias("spread"),
    )
    ranged = rows.repartitionByRange("conv_id", "turn", "digest", "spread")
    ranged = scratch.write(ranged.select("conv_id", "turn", "digest", "words", F.spark_partition_id().alias("block")), "turns")
    own = W.partitionBy("conv_id")
    earlier = own.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    counts = ranged.groupBy("block", "conv_id").agg(F.count("*").alias("held"))
    counts = scratch.write(counts.select("block", "conv_id", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"), F.sum("held").over(own).alias("n")), "blocks")
    return ranged, counts


def rebuilt_turns(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, and the number of turns of each.

    Conversation c becomes the first h turns of conversation ``c - c % 20``
    followed by its own turns after its first h, with ``h = crc32(c) % 4``.
    """
    ranged, counts = numbered_turns(conversations, scratch)
    sizes = counts.select("conv_id", "n").distinct()
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).cast("long")
    first = sizes.select(F.col("conv_id").alias("first"), F.col("n").alias("first_n"))
    info = sizes.select("conv_id", "n", family.alias("first"), shared.alias("h")).join(first, "first", "left")
    info = info.withColumn("m", F.least("h", F.coalesce("first_n", F.lit(0))))
    info = scratch.write(info.select("conv_id", "first", "h", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")), "conversations")
    inside = W.partitionBy("block", "conv_id").orderBy("turn", "digest")
    local = ranged.withColumn("local", F.row_number().over(inside))
    placed = local.join(counts.join(info, "conv_id").drop("n"), ["block", "conv_id"]).withColumn("place", F.col("before") + F.col("local"))
    placed = scratch.write(placed.select("conv_id", "block", "place", "digest", "words", "h", "m", "total"), "places")
    tops = placed.where(F.col("place") < MOST_SHARED).select(F.col("conv_id").alias("top"), "place", "digest", "words")
    heads = info.join(tops, (F.col("first") == F.col("top")) & (F.col("place") <= F.col("m")))
    heads = heads.select("conv_id", F.lit(-1).alias("block"), "place", "digest", "words", "total")
    tails = placed.where("place > h").select("conv_id", "block", (F.col("place") - F.col("h") + F.col("m")).alias("place"), "digest", "words", "total")
    return heads.unionByName(tails), info.select("conv_id", "total")


def prefixes(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """Node (``a``, ``b``) and parent (``pa``, ``pb``) of every turn; the root is (0, 0)."""
    items = turns.withColumns({"xa": F.xxhash64("place", "digest"), "xb": F.xxhash64("digest", "place", F.lit("b"))})
    items = scratch.write(items.drop("digest"), "items")
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    folded = items.groupBy("block", "conv_id").agg(F.bit_xor("xa").alias("ya"), F.bit_xor("xb").alias("yb"))
    carried = folded.select("block", "conv_id", *[F.coalesce(F.bit_xor(f"y{c}").over(earlier), F.lit(0)).alias(f"c{c}") for c in "ab"])
    so_far = W.partitionBy("block", "conv_id").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    local = items.withColumns({f"r{c}": F.bit_xor(f"x{c}").over(so_far) for c in "ab"}).join(carried, ["block", "conv_id"])
    keys = [F.col(f"r{c}").bitwiseXOR(F.col(f"c{c}")).alias(c) for c in "ab"]
    keyed = local.select("conv_id", "place", "words", "total", "xa", "xb", *keys)
    parents = [F.col(c).bitwiseXOR(F.col(f"x{c}")).alias(f"p{c}") for c in "ab"]
    return scratch.write(keyed.select("conv_id", "place", "words", "total", "a", "b", *parents), "prefixes")


def digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ids (``conv_id``) of every node.

    Ranges of (node, id) become pieces of text in many tasks; the pieces of a
    node, some thousand times fewer, are digested in order as they stream by.
    """

    def pieces(batches):
        node, ids, first = None, [], None
        for batch in batches:
            out = {"a": [], "b": [], "first": [], "ids": []}
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("a", "b", "conv_id")]
            for a, b, own in zip(*columns):
                if ids and (node != (a, b) or len(ids) == PIECE_IDS):
                    for name, value in zip(out, (*node, first, ",".join(ids))):
                        out[name].append(value)
                    ids = []
                if not ids:
                    node, first = (a, b), own
                ids.append(str(own))
            yield pa.RecordBatch.from_pydict(out, schema=piece_schema)
        if ids:
            yield pa.RecordBatch.from_pydict({"a": [node[0]], "b": [node[1]], "first": [first], "ids": [",".join(ids)]}, schema=piece_schema)

    def digest(batches):
        node, state = None, None
        for batch in batches:
            out = {"a": [], "b": [], "ends_sha256": []}
            for a, b, text in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("a", "b", "ids")]):
                if node == (a, b):
                    state.update(b",")
                else:
                    if node is not None:
                        for name, value in zip(out, (*node, state.hexdigest())):
                            out[name].append(value)
                    node, state = (a, b), hashlib.sha256()
                state.update(text.encode())
            yield pa.RecordBatch.from_pydict(out, schema=digest_schema)
        if node is not None:
            yield pa.RecordBatch.from_pydict({"a": [node[0]], "b": [node[1]], "ends_sha256": [state.hexdigest()]}, schema=digest_schema)

    long = pa.int64()
    piece_schema = pa.schema([("a", long), ("b", long), ("first", long), ("ids", pa.string())])
    digest_schema = pa.schema([("a", long), ("b", long), ("ends_sha256", pa.string())])
    ranged = ends.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    cut = ranged.select("a", "b", "conv_id").mapInArrow(pieces, "a long, b long, first long, ids string")
    return cut.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(digest, "a long, b long, ends_sha256 string")


def _round(live: DataFrame, k: int, scratch: Scratch, sums: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(raked nodes, spliced nodes, the smaller forest)."""
    kids = live.where("pa IS NOT NULL").groupBy("pa", "pb").agg(F.expr("count(*) AS kids"), F.expr("bit_xor(a) AS ca"), F.expr("bit_xor(b) AS cb"))
    state = live.alias("v").join(kids.alias("k"), F.expr("v.a = k.pa AND v.b = k.pb"), "left")
    heads = f"pa IS NOT NULL AND kids = 1 AND xxhash64(a, b, {k}) & 1 = 1 AS heads"
    state = scratch.write(state.selectExpr("v.*", "coalesce(kids, 0) AS kids", "ca", "cb").selectExpr("*", heads), "forest")
    raked = state.where("kids = 0 AND pa IS NOT NULL")
    below = state.where("kids > 0 AND NOT heads").selectExpr("a AS xa", "b AS xb", *[f"up_{s} AS edge_{s}" for s in sums])
    spliced = state.where("heads").join(below, F.expr("ca = xa AND cb = xb")).drop("xa", "xb")
    spliced = scratch.write(spliced, "spliced")

    def told_to(a: str, b: str, parent: str, gone: int, into: str, onto: str) -> list[str]:
        values = [f"{(v.format(s=s) or '0L')} AS {way}_{s}" for way, v in (("in", into), ("on", onto)) for s in sums]
        return [f"{a} AS ta", f"{b} AS tb", *[f"{'p' + c if parent else 'CAST(NULL AS LONG)'} AS n{c}" for c in "ab"], f"{gone} AS gone", *values]

    held = "{s} + up_{s}"
    told = raked.selectExpr(*told_to("pa", "pb", "", 0, held, ""))
    told = told.unionByName(spliced.selectExpr(*told_to("ca", "cb", "p", 0, "", held))).unionByName(spliced.selectExpr(*told_to("a", "b", "", 1, "", "")))
    told = told.groupBy("ta", "tb").agg(*[F.expr(f"max({c}) AS {c}") for c in ("na", "nb", "gone")], *[F.expr(f"sum({way}_{s}) AS {way}_{s}") for way in ("in", "on") for s in sums])
    staying = state.where("kids > 0 OR pa IS NULL").join(told, F.expr("a = ta AND b = tb"), "left").where("gone IS NULL OR gone = 0")
    smaller = staying.selectExpr(
        "a", "b", "coalesce(na, pa) AS pa", "coalesce(nb, pb) AS pb",
        *[f"{s} + coalesce(in_{s}, 0L) AS {s}" for s in sums], *[f"up_{s} + coalesce(on_{s}, 0L) AS up_{s}" for s in sums],
    )
    return raked.select("a", "b", *sums), spliced, scratch.write(smaller, "forest")


def subtree_totals(nodes: DataFrame, sums: list[str], scratch: Scratch) -> DataFrame:
    """``a``, ``b`` and the totals of ``sums`` over each node's subtree, its top included.

    ``nodes`` holds ``a``, ``b``, parent ``pa``, ``pb`` (null for a root) and the
    columns ``sums`` (long, not null).  Several roots, one chain and no rows are allowed.
    """
    live = nodes.select("a", "b", "pa", "pb", *sums, *[F.lit(0).cast("long").alias(f"up_{s}") for s in sums])
    rounds = []
    while True:
        raked, spliced, live = _round(live, len(rounds), scratch, sums)
        rounds.append((raked, spliced))
        if not live.where("pa IS NOT NULL").limit(1).count():
            break
    totals = live.select("a", "b", *sums)
    for raked, spliced in reversed(rounds):
        # the child a node was spliced above was alive after that round, so its total is known
        known = spliced.alias("s").join(totals.alias("t"), F.expr("s.ca = t.a AND s.cb = t.b"))
        opened = known.selectExpr("s.a", "s.b", *[f"t.{s} + s.{s} + s.edge_{s} AS {s}" for s in sums])
        totals = totals.unionByName(raked).unionByName(scratch.write(opened, "expanded"))
    return totals


def trie(turns: DataFrame, conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """The nodes of the trie of ``turns`` (see :func:`rebuilt_turns`) with all their columns."""
    found = prefixes(turns, scratch)
    made = found.groupBy("a", "b").agg(
        F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.min("place").alias("depth"),
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words"),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = conversations.groupBy().agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("a"), zero.alias("b"), none.alias("pa"), none.alias("pb"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("words"))
    nodes = scratch.write(made.unionByName(root), "nodes")
    kids = nodes.where("pa IS NOT NULL").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(kids, _NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = scratch.write(nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}), "nodes")
    totals = subtree_totals(nodes, ["n_leaves", "saved_tokens"], scratch)
    last = found.where("place = total").select("a", "b", "conv_id")
    last = last.unionByName(conversations.where("total = 0").select(zero.alias("a"), zero.alias("b"), "conv_id"))
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    full = nodes.drop("n_leaves", "saved_tokens").join(totals, _NODE).join(digests(last), _NODE, "left").join(parents, ["pa", "pb"], "left")
    return full.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations, a row per node.

    ``conversations`` holds ``conv_id``, ``turn``, ``role``, ``text``.  Null
    roles and texts are empty; null turns come first; turns of one number
    follow the digest of role and text, so repeated rows are repeated turns;
    rows without ``conv_id`` belong to no conversation; a text may be of any
    length (only its digest and number of words travel).  No conversations give
    no nodes.  Other columns are not read.
    """
    with Scratch(conversations.sparkSession) as scratch:
        turns, convs = rebuilt_turns(conversations, scratch)
        return scratch.keep(trie(turns, convs, scratch), "trie")


def crc32_sql(text: str) -> str:
    """DuckDB: the unsigned CRC-32 of an ASCII text."""
    taken = "xor(crc, bit)"
    bits = f"list_transform(range(8 * length({text})), lambda i: CASE WHEN i % 8 = 0 THEN ascii(substr({text}, i // 8 + 1, 1))::BIGINT ELSE 0::BIGINT END)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), lambda crc, bit: xor({taken} >> 1, 3988292384 * ({taken} & 1))), 4294967295)"


TRIE_SQL = rf"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY place) AS seq FROM turns GROUP BY conv_id),
shared AS (SELECT *, {crc32_sql('conv_id::VARCHAR')} % 4 AS h FROM own),
rebuilt AS (
    SELECT s.conv_id, list_concat(coalesce(f.seq[1:s.h], []), s.seq[s.h + 1:]) AS seq
    FROM shared s LEFT JOIN own f ON f.conv_id = s.conv_id - s.conv_id % 20),
placed AS (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS depth FROM rebuilt),
nodes AS (
    SELECT seq[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(seq) = depth), '') AS ends
    FROM placed GROUP BY ALL),
kids AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
own_values AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children,
           CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(n.prefix[n.depth].text, '{WORD}')) END AS saved
    FROM nodes n LEFT JOIN kids k ON n.prefix = k.prefix),
above AS (SELECT prefix, unnest(range(depth + 1)) AS top, n_children, saved FROM own_values),
totals AS (SELECT prefix[1:top] AS prefix, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY ALL)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, t.n_leaves::BIGINT AS n_leaves,
       t.saved_tokens::BIGINT AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM own_values v JOIN totals t ON v.prefix = t.prefix LEFT JOIN nodes p ON v.depth > 0 AND p.prefix = v.prefix[1:v.depth - 1]
"""


@query("op11_conversation_trie", TRIE_SQL)
def op11_conversation_trie(spark, sf_dir):
    return conversation_trie(table(spark, sf_dir, "conversations"))
