"""Near copies by SimHash and the generalised pigeonhole (operator 3).

Equal fingerprints fold first, so a group of copies is one value whatever its
size, and a value has at most as many neighbours as a ball of the allowed
distance has points.  The 64 bits are cut into parts of correlated bits; part i
is probed with every value at up to t_i flipped bits, and any thresholds with
sum(t_i + 1) = distance + 1 lose no pair (-1: the part is not probed).  Number
of parts and thresholds come from a dynamic program over candidate counts that
a pass over all fingerprints estimates for a bounded set of queries.  Probes
meet the index in an equi join, which verifies the distance as it joins.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.base import Scratch, fresh, needed, query, schema, table
from tallyline.llm.components import stars
from tallyline.shipping import by_value

by_value(__name__)

SHINGLE, DISTANCE, SEED = 3, 3, 42
#: Numbers of parts the plan chooses from, and queries the estimate uses.
PARTS, QUERIES_FOR_ESTIMATE = (2, 3, 4), 256
#: What sending one probe costs, in candidates verified.
PROBE_COST = 4.0

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash: a bit is set if more than half of the shingles' hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return int(np.uint64(xxhash.xxh64_intdigest(joined, SEED)).astype(np.int64))
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size) - 1
    start = end - size + 1
    one, n = xxhash.xxh64_intdigest, len(words) - shingle + 1
    hashes = np.fromiter((one(joined[s:e], SEED) for s, e in zip(start[:n].tolist(), end[shingle - 1 :].tolist())), np.uint64, n)
    columns = hashes.view(np.uint8).reshape(-1, 8)
    count = np.concatenate([np.bincount(columns[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(count * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(t, shingle) for t in texts], dtype="int64")

    return udf(text)


def correlated_parts(together: np.ndarray, rows: int, parts: int) -> list[list[int]]:
    """Bits grouped greedily by absolute correlation into ``parts`` of nearly equal size."""
    share = together / max(rows, 1)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    tie = np.abs(share - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(tie, 0)
    free, out = list(range(64)), []
    for k in range(parts):
        size = 64 // parts + (k < 64 % parts)
        first = max(free, key=lambda b: (tie[b, free].max(), -b))
        own = [first]
        while len(own) < size:
            own.append(max((b for b in free if b not in own), key=lambda b: (tie[b, own].mean(), -b)))
        out.append(sorted(own))
        free = [b for b in free if b not in own]
    return out


def allocate(costs: list[list[float]], distance: int) -> tuple[float, list[int]]:
    """Thresholds of least total cost; ``costs[i][t + 1]`` is the cost of part i at threshold t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (total, chosen) in best.items():
            for units in range(min(distance + 1 - spent, len(cost) - 1) + 1):
                offer = (total + cost[units], [*chosen, units - 1])
                if spent + units not in step or offer < step[spent + units]:
                    step[spent + units] = offer
        best = step
    return best[distance + 1]


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _co_counts(values: DataFrame) -> tuple[np.ndarray, int]:
    """How often two bits are set together, over all fingerprints."""

    def fold(frames):
        total, rows = np.zeros((64, 64), np.int64), 0
        for pdf in frames:
            for k in range(0, len(pdf), 1 << 16):
                raw = pdf["fp"].to_numpy(np.int64)[k : k + (1 << 16)].copy().view(np.uint8).reshape(-1, 8)
                bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
                total += np.rint(bits.T @ bits).astype(np.int64)
                rows += len(bits)
        cells = np.append(total.reshape(-1), rows)
        yield pd.DataFrame({"cell": np.arange(len(cells)), "n": cells})

    sums = values.select("fp").mapInPandas(fold, schema("cell int, n long")).groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(64 * 64 + 1, np.int64)
    for cell, n in sums:
        flat[cell] = n
    return flat[:-1].reshape(64, 64), int(flat[-1])


def _candidate_counts(values: DataFrame, masks: list[int], distance: int) -> np.ndarray:
    """Mean number of fingerprints within 0 .. distance of a query, inside each mask."""
    asked = np.array([r.fp for r in values.orderBy(F.xxhash64("fp"), "fp").limit(QUERIES_FOR_ESTIMATE).collect()], np.int64).view(np.uint64)

    def fold(frames):
        found = np.zeros((len(masks), distance + 1), np.int64)
        for pdf in frames:
            own = pdf["fp"].to_numpy(np.int64).copy().view(np.uint64)
            for k in range(0, len(own), 4096):
                apart = own[k : k + 4096, None] ^ asked[None, :]
                for i, mask in enumerate(masks):
                    d = np.bitwise_count(apart & np.uint64(mask))
                    found[i] += np.bincount(d.ravel(), minlength=65)[: distance + 1]
        yield pd.DataFrame({"cell": np.arange(found.size), "n": found.ravel()})

    sums = values.select("fp").mapInPandas(fold, schema("cell int, n long")).groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(masks) * (distance + 1))
    for cell, n in sums:
        out[cell] = n
    return np.cumsum(out.reshape(len(masks), distance + 1), axis=1) / max(len(asked), 1)


def choose_plan(values: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each probed part, the cheapest over the numbers of parts on offer."""
    together, rows = _co_counts(values)
    options = [correlated_parts(together, rows, n) for n in PARTS]
    masks = [_mask(bits) for parts in options for bits in parts]
    counts = iter(_candidate_counts(values, masks, distance))
    plans = []
    for parts in options:
        costs = []
        for bits in parts:
            near, probes = next(counts), np.cumsum([comb(len(bits), t) for t in range(distance + 1)])
            costs.append([0.0, *(near + PROBE_COST * probes).tolist()])
        total, thresholds = allocate(costs, distance)
        plans.append((total, list(zip(parts, thresholds))))
    return [(bits, t) for bits, t in min(plans, key=lambda p: p[0])[1] if t >= 0]


def links(values: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs (``a`` < ``b``) of distinct fingerprints that differ in at most ``distance`` bits."""
    index, probes = [], []
    for k, (bits, threshold) in enumerate(choose_plan(values, distance)):
        mask = F.lit(_signed(_mask(bits)))
        flips = [_signed(_mask(list(c))) for t in range(threshold + 1) for c in combinations(bits, t)]
        key = F.col("fp").bitwiseAND(mask)
        index.append(values.select(F.lit(k).alias("part"), key.alias("key"), F.col("fp").alias("b")))
        if len(flips) == 1:
            probes.append(values.select(F.lit(k).alias("part"), key.alias("key"), F.col("fp").alias("a")))
        else:
            one = F.explode(F.array(*[F.lit(f) for f in flips])).alias("flip")
            probes.append(values.select("fp", one).select(F.lit(k).alias("part"), key.bitwiseXOR(F.col("flip")).alias("key"), F.col("fp").alias("a")))
    left, right = probes[0], index[0]
    for more, other in zip(probes[1:], index[1:]):
        left, right = left.unionByName(more), right.unionByName(other)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return left.join(right, ["part", "key"]).where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def _classes(values: DataFrame, distance: int, scratch: Scratch) -> DataFrame:
    """``values`` (``fp``, ``least``) with ``root``: the least fingerprint of its component, by value."""
    ends = stars(links(values, distance), scratch)
    return values.join(ends.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_copies(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``fingerprint`` (16 hex digits) and ``component_id``.

    The component is everything reachable over links of at most ``distance``
    bits; its id is the least ``doc_id`` in it (null ids never name one, and a
    component of null ids alone has a null id).  A null, empty or blank text
    has fingerprint zero and links like any other; a text shorter than a
    shingle is one shingle; repeated rows share their component; no rows give
    no rows; other columns are not read.
    """
    with Scratch(docs.sparkSession) as scratch:
        rows = needed(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), fingerprint(F.col("text"), shingle).alias("fp"))
        rows = scratch.write(rows, "fingerprints")
        values = scratch.write(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
        classes = scratch.write(_classes(values, distance, scratch), "classes")
        ids = classes.groupBy("root").agg(F.min("least").alias("component_id"))
        named = classes.select("fp", "root").join(ids, "root").select("fp", "component_id")
        digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
        return scratch.keep(rows.join(named, "fp").select("doc_id", digits, "component_id"), "near-copies")


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component of :func:`near_copies`: that of the least id, nulls last.

    Of several texts with that id the one of least hash stays, and of equal
    rows one.  All columns are kept.  A row is known by its id and the hash of
    its text, so the texts themselves are neither copied nor sent to Python twice.
    """
    own = fresh(docs, "key_of_text")
    text_key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    with Scratch(docs.sparkSession) as scratch:
        rows = needed(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("id"), text_key.alias("text_key"), fingerprint(F.col("text"), shingle).alias("fp"))
        keys = scratch.write(rows.groupBy("fp", "id", "text_key").agg(F.count("*").alias("n")), "fingerprints")
        first = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key", "n")
        values = scratch.write(keys.groupBy("fp").agg(F.min(first).alias("first")), "distinct-fingerprints")
        classes = _classes(values, distance, scratch)
        winners = scratch.write(classes.groupBy("root").agg(F.min("first").alias("first")).select("first.id", "first.text_key", "first.n"), "winners")
        same = F.col("d.doc_id").cast("long").eqNullSafe(F.col("w.id")) & (F.col(f"d.{own}") == F.col("w.text_key"))
        met = docs.withColumn(own, text_key).alias("d").join(winners.alias("w"), same)
        columns = [F.col(f"d.`{c}`") for c in docs.columns]
        kept = met.where("w.n = 1").select(*columns)
        if winners.where("n > 1").limit(1).count():
            # rows that are there several times with one id
            again = met.where("w.n > 1").select(*columns, F.col(f"d.{own}"))
            once = again.groupBy(F.col("doc_id").cast("long"), own).agg(F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row"))
            kept = kept.unionByName(once.select(*[F.col(f"row.`{c}`") for c in docs.columns]))
        return scratch.keep(kept, "one-of-each")


@query("op3_simhash_near_dedup")
def op3_simhash_near_dedup(spark, sf_dir):
    return near_copies(table(spark, sf_dir, "documents"))
