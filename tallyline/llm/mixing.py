"""Mixing sources to target weights by entropy balancing (operator 8).

Rates closest in relative entropy to one, at most two, whose words add up to a
source's target are r = min(2, exp(lambda * x)) with x a document's size over
its source's scale.  Newton steps on the convex dual find every source's lambda
at once from one aggregation each over the counts of sizes; a bracket catches
steps that overshoot.  Rates become copies by hashed rounding, and a few passes
over 1,024 hash buckets a source move whole documents until the words taken
meet the target.  All that decides a row - its size, its hash, and its source's
parameters - is a column expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyline.llm.base import Scratch, fresh, needed, query, table

#: Shares of the sources in code point order, repeating; words of the mix per word there is; most copies of a document.
WEIGHTS, MIX_SHARE, MOST = (5.0, 2.0, 1.0), 1.5, 2.0
NEWTON_STEPS, TOLERANCE = 40, 1e-4
#: Passes that move whole documents after rounding, and hash buckets of each.
PASSES, BUCKETS = 5, 1024
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def _ranked(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """``sources`` with ``place``: 0, 1, ... by code point, null last, without gathering them in one task."""
    order = F.col("source").asc_nulls_last()
    ranged = scratch.write(sources.repartitionByRange(order).withColumn("range", F.spark_partition_id()), "source-ranges")
    before = ranged.groupBy("range").count().withColumn("skip", F.sum("count").over(W.orderBy("range")) - F.col("count"))
    own = F.row_number().over(W.partitionBy("range").orderBy(order)) - 1
    return ranged.join(before.select("range", "skip"), "range").select("source", "total", "least", "scale", (own + F.col("skip")).alias("place"))


def _level(sources: DataFrame) -> float:
    """Words per unit of weight once no target is above its source's limit."""
    w, cap = F.col("weight"), MOST * F.col("total")
    words, weights = sources.agg(F.sum("total"), F.sum(F.when(cap > 0, F.col("weight")))).head()
    if not words:
        return 0.0
    budget = MIX_SHARE * words
    level = budget / weights
    while True:
        full = w * level >= cap
        stopped, free = sources.agg(F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(w))).head()
        if not free:
            return level
        higher = (budget - stopped) / free
        if higher <= level * (1 + 1e-12):
            return level
        level = higher


def _rate(size: Column) -> Column:
    x = size / F.col("scale")
    return F.when(F.col("full"), F.lit(MOST)).otherwise(F.least(F.lit(MOST), F.exp(F.least(F.col("lam") * x, F.lit(1.0)))))


def _balance(counts: DataFrame, sources: DataFrame, scratch: Scratch) -> DataFrame:
    """``sources`` with ``lam`` and ``full``: the solution of every source's dual."""
    ln2 = math.log(MOST)
    # at hi every document that has words has the highest rate, at lo no rate is above the least double
    state = sources.select(
        "*", (F.col("target") >= MOST * F.col("total") * (1 - 1e-12)).alias("full"),
        F.greatest(F.lit(-40.0), F.log(F.greatest(F.col("target") / F.greatest("total", F.lit(1)), F.lit(1e-12)))).alias("lam"),
        (F.lit(-700.0) * F.col("scale") / F.col("least")).alias("lo"), (F.lit(ln2) * F.col("scale") / F.col("least")).alias("hi"),
    )
    state = scratch.write(state.withColumn("lam", F.least(F.greatest("lam", "lo"), "hi")), "dual")
    fixed = [c for c in state.columns if c not in ("lam", "lo", "hi")]
    for _ in range(NEWTON_STEPS):
        open_ = state.where("NOT full").select("source", "scale", "lam", "full")
        s, o = counts.alias("s"), open_.alias("o")
        met = s.join(o, F.col("s.source").eqNullSafe(F.col("o.source"))).select(F.col("o.source").alias("source"), "size", "n", "scale", "lam", "full")
        rate, words = _rate(F.col("size")), F.col("n") * F.col("size")
        sums = met.groupBy("source").agg(
            F.sum(words * rate).alias("got"), F.sum(F.when(rate < MOST, words * rate * F.col("size") / F.col("scale")).otherwise(0.0)).alias("slope"),
        )
        a, b = state.alias("a"), sums.alias("b")
        both = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")), "left").select("a.*", "got", "slope")
        gap = F.col("target") - F.col("got")
        both = both.withColumns({"lo": F.when(gap > 0, F.col("lam")).otherwise(F.col("lo")), "hi": F.when(gap < 0, F.col("lam")).otherwise(F.col("hi"))})
        step = F.col("lam") + gap / F.col("slope")
        inside = (F.col("slope") > 0) & (step > F.col("lo")) & (step < F.col("hi"))
        moved = F.when(F.col("got").isNull() | (gap == 0), F.col("lam")).when(inside, step).otherwise((F.col("lo") + F.col("hi")) / 2)
        off = F.coalesce(F.abs(gap) / F.greatest("target", F.lit(1.0)), F.lit(0.0))
        done = F.when(off <= TOLERANCE, F.col("lam")).otherwise(moved)
        state = scratch.write(both.select(*fixed, "lo", "hi", done.alias("lam"), off.alias("off")), "dual")
        if (state.agg(F.max("off")).head()[0] or 0.0) <= TOLERANCE:
            break
        state = state.drop("off")
    # rounded, so that the order of a sum cannot change a copy between runs
    return state.select(*fixed, F.round("lam", 9).alias("lam"))


def _bucket(salt: int) -> Column:
    return F.pmod(F.xxhash64("mark", F.lit(salt)), F.lit(BUCKETS))


def _copies(passes: int) -> Column:
    """Copies of a row from ``size``, ``mark`` and its source's parameters, after so many passes."""
    chance = F.pmod(F.col("mark"), F.lit(1 << 40)) / float(1 << 40)
    out = F.least(F.floor(_rate(F.col("size")) + chance), F.lit(int(MOST))).cast("int")
    for k in range(passes):
        gap = F.col(f"gap{k}")
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs(gap)) & (_bucket(k) <= F.col(f"cut{k}"))
        moved = out + F.when(fits, F.signum(gap).cast("int")).otherwise(0)
        out = F.least(F.greatest(moved, F.lit(0)), F.lit(int(MOST)))
    return out


def _with_source(rows: DataFrame, params: DataFrame) -> DataFrame:
    """``rows`` with the parameters of their source, the null source among them; names of ``rows`` win."""
    own = params.withColumnRenamed("source", "of_source")
    return rows.join(own, rows["source"].eqNullSafe(own["of_source"])).drop("of_source")


def _settle(rows: DataFrame, params: DataFrame, scratch: Scratch) -> DataFrame:
    """``params`` with the passes' gaps and bucket limits."""
    for k in range(PASSES):
        now = _with_source(rows, params).withColumn("copies", _copies(k))
        taken = now.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
        p, t = params.alias("p"), taken.alias("t")
        held = p.join(t, F.col("p.source").eqNullSafe(F.col("t.source"))).select("p.*", (F.col("target") - F.col("taken")).alias(f"gap{k}"))
        held = scratch.write(held, "gaps")
        gap = F.col(f"gap{k}")
        free = _with_source(rows, held).withColumn("copies", _copies(k))
        free = free.where((F.col("size") > 0) & (F.col("size") <= F.abs(gap)) & (((gap > 0) & (F.col("copies") < MOST)) | ((gap < 0) & (F.col("copies") > 0))))
        sums = free.groupBy("source", _bucket(k).alias("bucket"), F.abs(gap).alias("room")).agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(W.partitionBy("source").orderBy("bucket"))
        last = sums.withColumn("upto", upto).where("upto <= room").groupBy("source").agg(F.max("bucket").alias(f"cut{k}"))
        h, b = held.alias("h"), last.alias("b")
        joined = h.join(b, F.col("h.source").eqNullSafe(F.col("b.source")), "left")
        params = scratch.write(joined.select("h.*", F.coalesce(F.col(f"b.cut{k}"), F.lit(-1)).alias(f"cut{k}")), "gaps")
    return params


def solve(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Parameters of every source of ``rows`` (``source``, ``size``, ``mark``), a row each."""
    counts = scratch.write(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "size-counts")
    words = F.col("n") * F.col("size")
    sums = counts.groupBy("source").agg(
        F.sum(words).alias("total"), F.coalesce(F.min(F.when(F.col("size") > 0, F.col("size"))), F.lit(1)).alias("least"),
        F.greatest(F.sum(words * F.col("size")) / F.greatest(F.sum(words), F.lit(1)), F.lit(1.0)).alias("scale"),
    )
    places = _ranked(sums, scratch)
    weight = F.element_at(F.array(*[F.lit(x) for x in WEIGHTS]), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    sources = scratch.write(places.withColumn("weight", weight), "sources")
    target = F.least(F.col("weight") * F.lit(_level(sources)), MOST * F.col("total"))
    sources = sources.withColumn("target", target.cast("double"))
    return _settle(rows, _balance(counts.where("size > 0"), sources, scratch), scratch)


def _mark() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")))


def mix(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` its ``size``, its source's ``source_size`` and ``target``, and the words ``taken`` of it.

    Only ``doc_id``, ``text`` and ``source`` are read.  A null text has size 0
    and nothing is taken of it; a null source is a source, the last one; rows
    with equal id and text always get equal copies; a source without words has
    target 0; no rows give no rows.
    """
    with Scratch(docs.sparkSession) as scratch:
        own = needed(docs, "doc_id", "text", "source").select(
            F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"), _mark().alias("mark"))
        rows = scratch.write(own, "sizes")
        params = solve(rows, scratch)
        taken = (_copies(PASSES) * F.col("size")).cast("long").alias("taken")
        out = _with_source(rows, params).select("doc_id", "size", F.col("total").alias("source_size"), "target", taken)
        return scratch.keep(out, "mix")


def apply_mix(docs: DataFrame) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; ``copy`` numbers the copies from 1."""
    copy = fresh(docs, "copy")
    with Scratch(docs.sparkSession) as scratch:
        own = needed(docs, "doc_id", "text", "source").select(F.col("source").cast("string"), word_count(F.col("text")).alias("size"), _mark().alias("mark"))
        params = solve(scratch.write(own, "sizes"), scratch)
        staged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("source").cast("string").alias("source"),
                             word_count(F.col("text")).alias("size"), _mark().alias("mark"))
        copies = _with_source(staged, params).select("row", _copies(PASSES).alias("copies")).where("copies > 0")
        out = copies.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias(copy))
        return scratch.keep(out.select(*[F.col(f"row.`{c}`") for c in docs.columns], copy), "mixed")


@query("op8_source_mixing")
def op8_source_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))
