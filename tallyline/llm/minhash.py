"""Near copies by fast similarity sketching, banding and exact verification (operator 13).

A sketch has :data:`COORDINATES` bins.  In round i every shingle of a set falls
into one hashed bin with value (i, hash); a bin keeps its least value, so once
filled it is settled.  After as many rounds as bins, round COORDINATES + b puts
every shingle into bin b, so every bin fills for certain and the sketch agrees
in a share of bins that is concentrated about the similarity.

Equal sets fold into one before anything is compared.  Bands of
:data:`ROWS` coordinates then gather candidates: a pair at the similarity asked
for misses all bands with probability (1 - 0.85^5)^32 < 1e-8.  Inside a band's
bucket first every set meets only the bucket's centre (the set with most
company over all its bands), which links most of a large group in as many pairs
as members.  Sets of buckets that still
hold several components then meet by their rarest shingles (a prefix filter,
which is exact), in pairs of different components whose sketches agree as often
as the concentration demands.  Links are confirmed on full sets.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.base import Scratch, needed, query, schema, table
from tallyline.llm.components import stars
from tallyline.llm.words import BASES, Block, U, blocks, mix, rolling
from tallyline.shipping import by_value

by_value(__name__)

SHINGLE, PERCENT = 5, 85
COORDINATES, ROWS = 160, 5
BANDS = COORDINATES // ROWS
#: Bins that agree by less than this cannot be a link: 136 are expected at 0.85, with a deviation below 4.6.
AGREE = 104
#: The rarity of shingles is counted in 2^CELL_BITS cells.
CELL_BITS = 16
#: Wanted texts are told from others by a bit each in a table of at most 2^FILTER_BITS bits (32 MB).
FILTER_BITS = 28
#: Elements hashed at a time.
ELEMENTS = 1 << 21

_LATER = U(55)


def shingle_sets(raws: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of lower-cased texts, ascending within each, and their number per text."""
    block = Block([r.lower() for r in raws])
    hashes = block.word_hashes()
    whole = block.windows(size)
    rolled = rolling(hashes, size, BASES[1])
    texts, values = [block.text[whole]], [rolled[whole] if len(whole) else np.empty(0, U)]
    for k in np.flatnonzero((block.count > 0) & (block.count < size)):
        own = hashes[block.first[k] : block.first[k] + block.count[k]]
        texts.append(np.array([k]))
        values.append(mix(rolling(own, len(own), BASES[1]) + U(len(own))))
    text, value = np.concatenate(texts), np.concatenate(values)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return value[new], np.bincount(text[new], minlength=len(raws))


def sketches(values: np.ndarray, sizes: np.ndarray, bins: int = COORDINATES) -> np.ndarray:
    """A row of ``bins`` coordinates per set; ``values`` are the sets end to end.  An empty set keeps the largest value."""
    empty = ~U(0)
    out = np.full((len(sizes), bins), empty)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    flat = out.reshape(-1)
    for k in range(2 * bins):
        if not len(owner):
            break
        h = mix(values ^ mix(np.full(1, k + 1, U) * U(BASES[2]))[0])
        landed = ((h >> U(32)) * U(bins) >> U(32)).astype(np.int64) if k < bins else np.full(len(h), k - bins)
        # the round comes first, so a later one never displaces an earlier
        np.minimum.at(flat, owner * bins + landed, (U(k) << _LATER) | (mix(h) >> U(64 - 55)))
        if k % 4 == 3 or k >= bins:
            full = (out != empty).all(axis=1)
            if full.any():
                left = ~full[owner]
                owner, values = owner[left], values[left]
    return out


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A key per band, different for equal rows of different bands."""
    bands = sketch.shape[1] // rows
    out = np.tile(np.arange(1, bands + 1).astype(U), (len(sketch), 1))
    for k in range(rows):
        out = mix(out * U(BASES[0]) + sketch[:, k::rows][:, :bands])
    return out


def short_sketch(sketch: np.ndarray) -> np.ndarray:
    """One byte a coordinate."""
    return (mix(sketch) >> U(56)).astype(np.uint8)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _sketched(docs: DataFrame, size: int) -> DataFrame:
    """A row per row of ``docs``: id, hash of the text, set (key and size), keys of its bands, short sketch."""
    made = "n_shingles long, set_key long, bands array<long>, short binary"
    names = ["doc_id", "text_key", *[c.split()[0] for c in made.split(", ")]]

    def run(batches):
        for batch in batches:
            for first, raws in blocks(batch.column(2).to_pylist(), ELEMENTS):
                values, sizes = shingle_sets(raws, size)
                key = np.zeros(len(raws), U)
                np.bitwise_xor.at(key, np.repeat(np.arange(len(raws)), sizes), mix(values ^ U(BASES[0])))
                key = mix(key + sizes.astype(U))
                sketch = sketches(values, sizes)
                some = sizes > 0
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(raws)), batch.column(1).slice(first, len(raws)), pa.array(sizes), pa.array(key.view(np.int64)),
                    _lists(band_keys(sketch)[some].reshape(-1), np.where(some, BANDS, 0)), pa.array([s.tobytes() for s in short_sketch(sketch)], pa.binary()),
                ], names)

    rows = needed(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), _text_key(F.col("text")).alias("text_key"), "text")
    return rows.mapInArrow(run, f"doc_id long, text_key long, {made}")


def _may_be_wanted(wanted: DataFrame, doc_id: str, text_key: str, most: int = FILTER_BITS) -> Column:
    """Is a row (``doc_id``, ``text_key``) among ``wanted`` (``id``, ``of``)?  Never false for one that is, seldom true for others.

    A bit per hash cell, eight times as many as wanted rows and 2^``most`` at
    most, is set where a wanted row falls into the cell.  Where more are wanted
    the table fills up and lets more rows pass, to the join behind it.
    """
    bits = min(most, max(16, (8 * wanted.count()).bit_length()))
    cell = F.shiftrightunsigned(F.xxhash64("id", "of"), 64 - bits)
    rows = wanted.select(cell.alias("cell")).groupBy(F.shiftright("cell", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(cell & 63 AS int)))").alias("bits")
    ).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    held = wanted.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    @F.pandas_udf("boolean")
    def udf(hashes: pd.Series) -> pd.Series:
        cells = hashes.to_numpy(np.int64).view(np.uint64) >> U(64 - bits)
        return pd.Series((held.value[cells >> U(6)] >> (cells & U(63)) & U(1)).astype(bool))

    return udf(F.xxhash64(doc_id, text_key))


def _with_shingles(sets: DataFrame, docs: DataFrame, size: int, scratch: Scratch, *keep: str) -> DataFrame:
    """``sets`` (``set_key``, ``doc_id``, ``text_key``, ``keep``) with their ``shingles``, read again from one text each."""
    wanted = scratch.write(sets.select("set_key", F.col("doc_id").alias("id"), F.col("text_key").alias("of"), *keep), "wanted-sets")
    texts = needed(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), _text_key(F.col("text")).alias("key"), "text")
    # only texts that may be wanted are shuffled
    near = texts.where(_may_be_wanted(wanted, "doc_id", "key"))
    met = near.join(wanted, (F.col("key") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")))
    # a row may be there several times
    once = met.groupBy("set_key", *keep).agg(F.first("text").alias("text"))
    kept = [f for f in once.schema.fields if f.name != "text"]

    def run(batches):
        for batch in batches:
            for first, raws in blocks(batch.column(len(kept)).to_pylist(), ELEMENTS):
                values, sizes = shingle_sets(raws, size)
                yield pa.RecordBatch.from_arrays([*[batch.column(k).slice(first, len(raws)) for k in range(len(kept))], _lists(values, sizes)], [*[f.name for f in kept], "shingles"])

    return scratch.write(once.mapInArrow(run, T.StructType([*kept, *schema("shingles array<long>").fields])), "shingle-sets")


def _agree(a: str, b: str) -> Column:
    """Bins in which two short sketches agree, where they reach :data:`AGREE`."""

    @F.pandas_udf("boolean")
    def udf(x: pd.Series, y: pd.Series) -> pd.Series:
        left = np.frombuffer(b"".join(x), np.uint8).reshape(len(x), -1)
        right = np.frombuffer(b"".join(y), np.uint8).reshape(len(y), -1)
        return pd.Series((left == right).sum(axis=1) >= AGREE)

    return udf(F.col(a), F.col(b))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (``a``, ``b`` set keys) whose shingle sets are similar enough."""
    one = sets.select(F.col("set_key").alias("a"), F.col("shingles").alias("of_a"))
    two = sets.select(F.col("set_key").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.join(one, "a").join(two, "b").withColumn("shared", F.size(F.array_intersect("of_a", "of_b")))
    close = both.where(100 * F.col("shared") >= percent * (F.size("of_a") + F.size("of_b") - F.col("shared")))
    return scratch.write(close.select("a", "b"), "links")


def _fits(a: str, b: str, percent: int) -> Column:
    """Sizes that allow the similarity at all."""
    return (100 * F.col(a) >= percent * F.col(b)) & (100 * F.col(b) >= percent * F.col(a))


def _centre_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Every member of a bucket with the bucket's centre."""
    centre = members.groupBy("bucket").agg(F.max(F.struct("company", "set_key", "n", "short")).alias("c"))
    met = members.join(centre, "bucket").where((F.col("set_key") != F.col("c.set_key")) & _fits("n", "c.n", percent))
    sided = met.select(F.least("set_key", "c.set_key").alias("a"), F.greatest("set_key", "c.set_key").alias("b"), "short", F.col("c.short").alias("other"))
    return sided.where(_agree("short", "other")).select("a", "b").distinct()


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> U(64 - CELL_BITS)).astype(np.int64)


def _spread(rest: DataFrame) -> np.ndarray:
    """Number of shingles of ``rest`` by cell of their hash: a table of fixed size, folded in the tasks."""

    def fold(batches):
        total = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            held = batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            total += np.bincount(_cells(held), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["cell", "held"])

    sums = rest.select("shingles").mapInArrow(fold, "cell long, held long").groupBy("cell").agg(F.sum("held").alias("held")).toArrow()
    out = np.zeros(1 << CELL_BITS, np.int64)
    out[sums.column("cell").to_numpy()] = sums.column("held").to_numpy()
    return out


def _prefixes(rest: DataFrame, percent: int) -> DataFrame:
    """The first shingles of every set in the order of (cell count, hash), as many as the smallest partner leaves."""
    spread = rest.sparkSession.sparkContext.broadcast(_spread(rest))

    def run(batches):
        common = spread.value
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((values, common[_cells(values)], owner))
            at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            kept = np.flatnonzero(at <= (sizes - -(-percent * sizes // 100))[owner])
            own = pa.array(owner[kept])
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(own), batch.column(1).take(own), pa.array(sizes[owner[kept]].astype(np.int64)),
                pa.array(at[kept]), pa.array(values[order][kept].view(np.int64)),
            ], ["set_key", "root", "n", "at", "shingle"])

    return rest.select("set_key", "root", "shingles").mapInArrow(run, "set_key long, root long, n long, at long, shingle long")


def _prefix_pairs(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs of ``rest`` (sets with ``root``) in different components that share one of their rarest shingles.

    In one order of all shingles, rarest first, the first one that two sets share
    stands behind at most ``n - overlap`` others in either, with ``overlap`` the
    least a pair of these sizes shares at ``percent``.  So a match counts only
    that early in both: nothing is lost in any order, and the rarest keep pairs
    few.  Rarity is read from counts by hash cell, which tell what many sets share.
    """
    prefix = _prefixes(rest, percent)
    other = prefix.select(F.col("set_key").alias("b"), F.col("root").alias("b_root"), F.col("n").alias("b_n"), F.col("at").alias("b_at"), "shingle")
    least = percent * (F.col("n") + F.col("b_n"))
    early = ((100 + percent) * (F.col("n") - F.col("at")) >= least) & ((100 + percent) * (F.col("b_n") - F.col("b_at")) >= least)
    met = prefix.join(other, "shingle").where((F.col("set_key") < F.col("b")) & (F.col("root") != F.col("b_root")) & _fits("n", "b_n", percent) & early)
    pairs = met.select(F.col("set_key").alias("a"), "b").distinct()
    of_a, of_b = [rest.select(F.col("set_key").alias(c), F.col("short").alias(f"of_{c}")) for c in "ab"]
    return pairs.join(of_a, "a").join(of_b, "b").where(_agree("of_a", "of_b")).select("a", "b")


def similar_sets(sets: DataFrame, docs: DataFrame, scratch: Scratch, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Links (``a``, ``b`` set keys) that connect exactly what all similar pairs of ``sets`` connect.

    ``sets``: one row per distinct set, with ``set_key``, ``n`` (size), ``bands``,
    ``short``, and ``doc_id`` and ``text_key`` of a row of ``docs`` with that set.
    Texts are read again for sets that have a candidate only.
    """
    light = sets.select("set_key", F.explode("bands").alias("bucket"))
    shared = light.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1")
    inside = scratch.write(light.join(shared, "bucket"), "buckets")
    company = inside.groupBy("set_key").agg(F.sum("held").alias("company"))
    members = scratch.write(inside.drop("held").join(sets.select("set_key", "n", "short").join(company, "set_key"), "set_key"), "members")
    near_centre = scratch.write(_centre_pairs(members, percent), "centre-pairs")
    paired = near_centre.select(F.explode(F.array("a", "b")).alias("set_key")).distinct()
    links = _confirmed(near_centre, _with_shingles(sets.join(paired, "set_key"), docs, shingle, scratch), percent, scratch)
    roots = stars(links, scratch).withColumnRenamed("node", "set_key")
    placed = members.select("set_key", "bucket").join(roots, "set_key", "left").withColumn("root", F.coalesce("root", "set_key"))
    placed = scratch.write(placed, "placed")
    split = placed.groupBy("bucket").agg((F.min("root") != F.max("root")).alias("split")).where("split").drop("split")
    rest = placed.join(split, "bucket", "left_semi").groupBy("set_key", "root").agg(F.lit(1).alias("one")).drop("one")
    rest = _with_shingles(sets.join(rest, "set_key"), docs, shingle, scratch, "n", "short", "root")
    more = scratch.write(_prefix_pairs(rest, percent).join(near_centre, ["a", "b"], "left_anti"), "prefix-pairs")
    return links.unionByName(_confirmed(more, rest, percent, scratch))


def minhash_copies(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``n_shingles``, ``component_id``, ``kept``.

    A document's set holds its distinct shingles of lower-cased (A-Z) words; a
    text with fewer words is one shingle; null, empty and blank texts have the
    empty set and link with nothing, not even one another.  Documents link at
    ``100 * intersection >= percent * union``; ``component_id`` is the least
    ``doc_id`` reachable (null where a component has null ids only; a row with a
    null id is never kept).  Repeated rows share their component, equal ids with
    different texts stay different rows, long texts are read whole, no rows
    give no rows, and other columns are not read.  Shingles equal in 64 bits count as equal.
    """
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.write(_sketched(docs, shingle), "sketches")
        # equal sets become one, known by one of their texts
        same = [F.first(c).alias(c) for c in ("bands", "short")]
        one = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("one")
        values = rows.where("n_shingles > 0").groupBy("set_key").agg(F.first("n_shingles").alias("n"), one, *same)
        values = scratch.write(values.select("set_key", "n", "one.doc_id", "one.text_key", "bands", "short"), "distinct-sets")
        ends = stars(similar_sets(values, docs, scratch, shingle, percent), scratch).withColumnRenamed("node", "set_key")
        classes = scratch.write(values.join(ends, "set_key", "left").select("set_key", F.col("doc_id").alias("least"), F.coalesce("root", "set_key").alias("root")), "classes")
        named = classes.join(classes.groupBy("root").agg(F.min("least").alias("component")), "root").select("set_key", "component")
        whole = rows.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
        alone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
        out = whole.select("doc_id", "n_shingles", alone.alias("component_id"))
        return scratch.keep(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))), "near-copies")


MINHASH_SQL = rf"""
WITH RECURSIVE split AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
sets AS (
    SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
           ELSE list_distinct(list_transform(range(len(w) - {SHINGLE - 1}), lambda i: array_to_string(w[i + 1:i + {SHINGLE}], ' '))) END AS s
    FROM split),
items AS (SELECT r, len(s) AS n, unnest(s) AS item FROM sets),
pairs AS (SELECT a.r AS ra, b.r AS rb, count(*) AS shared, any_value(a.n) AS na, any_value(b.n) AS nb FROM items a JOIN items b ON a.item = b.item AND a.r <> b.r GROUP BY ALL),
links AS (SELECT ra, rb FROM pairs WHERE 100 * shared >= {PERCENT} * (na + nb - shared)),
reached AS (SELECT r AS of, r AS at FROM sets UNION SELECT reached.of, links.rb FROM reached JOIN links ON links.ra = reached.at),
least AS (SELECT of, min(sets.doc_id) AS component_id FROM reached JOIN sets ON sets.r = reached.at GROUP BY of)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, coalesce(doc_id = component_id, false) AS kept FROM sets JOIN least ON least.of = sets.r
"""


@query("op13_minhash_near_dedup", MINHASH_SQL)
def op13_minhash_near_dedup(spark, sf_dir):
    return minhash_copies(table(spark, sf_dir, "documents"))
