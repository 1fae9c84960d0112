"""Benchmark passages in documents by template windows (operator 1).

Numbers, names and units become typed slots that keep their value: a token is a
lower-case word, or a mark (1 name, 2 number, 3 unit, 4 capital that opens a
sentence) followed by the value.  Windows of five tokens, slots reduced to their
mark, are hashed and joined with the windows of the benchmark, in three forms:
as a template (opening capitals are words), plain (names are words as well, so
case and punctuation do not matter) and open (opening capitals are names).  A
document that holds enough of an item's windows of one form, or a long aligned
run of them, is a candidate; it is a leak if along the alignment every slot
value of the item keeps one value in the document.
All of it is column expressions and joins; only windows that meet the benchmark
leave the scan.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyline.llm.base import Scratch, fresh, needed, query, table

WINDOW = 5
#: Words (not slots) a benchmark window needs to be looked for by marks; plain windows with fewer are looked for by their values.
LITERALS = 3
#: Tokens an item needs to be looked for; one of fewer tokens than a window is a window of its own length.
LEAST = 3
#: Share of an item's windows a document must hold, or the windows of one alignment that are enough.
CONTAINED, RUN = 0.8, 9
#: Share of an item's slot values that must keep one value.
CONSISTENT = 0.8
#: Benchmark windows up to which the index is broadcast (32 bytes each); more are joined by shuffle.
BROADCAST_WINDOWS = 1_000_000

# fixed values: unit words after a number
UNITS = (
    "mm", "cm", "m", "km", "in", "inch", "inches", "ft", "foot", "feet", "yard", "yards", "mile", "miles", "mg", "g", "kg", "gram", "grams",
    "ton", "tons", "lb", "lbs", "oz", "pound", "pounds", "ml", "l", "liter", "liters", "litre", "litres", "gallon", "gallons", "ms", "s", "sec",
    "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years",
    "dollar", "dollars", "euro", "euros", "cent", "cents", "percent", "degree", "degrees", "kb", "mb", "gb", "hz", "w", "kw", "v", "mph",
)

#: Forms of windows; the last is the plain one with values.
TEMPLATE, PLAIN, OPEN, VALUED = 0, 1, 2, 3

_CAPITAL = r"""\p{Lu}(?<![\p{L}\p{M}\p{N}]\p{Lu})[\p{L}\p{M}]*+"""
_INSIDE = r"""\x04(?<=[\p{L}\p{N},;:)"'](?:\s|[ \t]{2,8})\x04)"""
_NUMBER = r"(?<![\p{L}\p{N}.,])[0-9]++(?:[.,:/-][0-9]++)*+"
_UNIT = r"(\x02[0-9.,:/-]*[0-9]\s?)(" + "|".join(sorted(UNITS, key=len, reverse=True)) + r")(?![\p{L}\p{N}])"
_TOKEN = r"\x02[0-9]++(?:[.,:/-][0-9]++)*+|[\x01\x03\x04]?[\p{L}\p{M}\p{N}]++"
#: Everything that sorts below this begins with a mark.
_WORDS_FROM = "\u0005"


def tokens(text: Column) -> Column:
    """Template tokens of a text, slots with mark and value; none for null."""
    named = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), _CAPITAL, "\u0004$0"), _INSIDE, "\u0001")
    numbered = F.regexp_replace(F.regexp_replace(named, _NUMBER, "\u0002$0"), _UNIT, "$1\u0003$2")
    return F.regexp_extract_all(F.lower(F.when(named.rlike("[0-9]"), numbered).otherwise(named)), F.lit(_TOKEN), F.lit(0))


def _is_slot(token: Column) -> Column:
    return token < F.lit(_WORDS_FROM)


def _word(token: Column) -> Column:
    """A token without the mark of a name."""
    return F.when(token.startswith("\u0001") | token.startswith("\u0004"), F.substring(token, 2, 1 << 30)).otherwise(token)


def plain(toks: Column) -> Column:
    """Tokens with names as words; a unit is any unit word after a number, whatever its case."""

    def one(t: Column, i: Column) -> Column:
        word = F.when(_is_slot(t), F.substring(t, 2, 1 << 30)).otherwise(t)
        unit = F.get(toks, i - 1).startswith("\u0002") & word.isin(*UNITS)
        return F.when(t.startswith("\u0002"), t).when(unit, F.concat(F.lit("\u0003"), word)).otherwise(word)

    return F.transform(toks, one)


def _reduced(toks: Column, form: int) -> Column:
    """Tokens with slots reduced to their mark; ``toks`` are the plain ones for that form."""

    def one(t: Column) -> Column:
        kind = F.substring(t, 1, 1)
        opening = F.lit("\u0001") if form == OPEN else F.substring(t, 2, 1 << 30)
        return F.when(t >= _WORDS_FROM, t).when(kind == "\u0004", opening).otherwise(kind)

    return F.transform(toks, one)


def _windows(toks: Column, length: int = WINDOW) -> Column:
    """Hash of the window at every place; a shorter text is one window."""
    last = F.greatest(F.size(toks) - length, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(toks, i + 1, F.lit(length))))


def _kind(token: Column) -> Column:
    """Number of a token's mark, 0 of a word."""
    marked = F.when(token < "\u0002", 1).when(token < "\u0003", 2).when(token < "\u0004", 3).otherwise(4)
    return F.when(_is_slot(token), marked).otherwise(0)


def _any(tests: list[Column]) -> Column:
    return functools.reduce(operator.or_, tests)


def _probes(read: DataFrame, lengths: list[int]) -> DataFrame:
    """``place`` and ``hash`` of the windows of every document, all lengths and forms out of one read.

    A window of another form is there only if it may differ from the template's, one by values only if it is poor in
    words.  Windows are rows and their hash is columns, not functions over arrays, so that all of it is compiled.
    """
    steps = range(WINDOW)
    # a filter on ``toks`` itself would be evaluated below it and so make the tokens twice
    last = F.greatest(F.size("toks") - min(lengths), F.lit(0))
    placed = read.select("doc_id", "text_key", "toks", F.explode(F.sequence(F.lit(0), last)).alias("place"))
    if len(lengths) == 1:
        sized = placed.withColumn("length", F.lit(lengths[0]))
    else:
        sized = placed.select("*", F.explode(F.array(*[F.lit(n) for n in lengths])).alias("length"))
    whole = sized.where(F.col("place") + F.col("length") <= F.size("toks"))
    # the token before the window tells whether its first is a unit
    at = [F.get("toks", F.col("place") - 1), *[F.when(F.col("length") > k, F.get("toks", F.col("place") + k)) for k in steps]]
    taken = whole.select("doc_id", "text_key", "place", "length", *[t.alias(f"t{k}") for k, t in enumerate(at)])
    kinds = taken.select("*", *[_kind(F.col(f"t{k}")).alias(f"k{k}") for k in range(WINDOW + 1)])
    kind = [F.col(f"k{k}") for k in range(WINDOW + 1)]
    opens = _any([k == 4 for k in kind[1:]])
    values = _any([k == 2 for k in kind])
    plains = values | _any([k.isin(1, 3) for k in kind[1:]])
    slots = sum((((kind[k + 1] == 2) | (kind[k] == 2)) & F.col(f"t{k + 1}").isNotNull()).cast("int") for k in steps)
    poor = values & (slots > F.col("length") - LITERALS)

    def forms(*which: int) -> Column:
        return F.array(*[F.lit(f) for f in which])

    wanted = F.when(~plains, F.when(opens, forms(TEMPLATE, OPEN)).otherwise(forms(TEMPLATE)))
    wanted = wanted.when(poor, forms(TEMPLATE, PLAIN, OPEN, VALUED)).when(opens, forms(TEMPLATE, PLAIN, OPEN)).otherwise(forms(TEMPLATE, PLAIN))
    formed = kinds.select("*", F.explode(wanted).alias("form"))
    form = F.col("form")

    def one(k: int) -> Column:
        t, mark, after = F.col(f"t{k}"), F.col(f"k{k}"), F.col(f"k{k - 1}") == 2
        word = F.when(mark == 0, t).otherwise(F.substring(t, 2, 1 << 30))
        typed = form.isin(TEMPLATE, OPEN)
        slot = F.when(mark == 3, "\u0003").when((mark == 4) & (form == TEMPLATE), word).otherwise("\u0001")
        unit = F.when(form == VALUED, F.concat(F.lit("\u0003"), word)).otherwise("\u0003")
        number = F.when(form == VALUED, t).otherwise("\u0002")
        return F.when((mark == 0) & (typed | ~after), t).when(mark == 2, number).when(typed, slot).when(after & word.isin(*UNITS), unit).otherwise(word)

    return formed.select("doc_id", "text_key", "place", F.xxhash64(*[one(k + 1) for k in steps]).alias("hash"))


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``item_id``, ``toks``, ``form``, ``windows`` (number looked for), ``place``, ``hash`` of every informative window."""
    items = needed(benchmark, "item_id", "text").withColumn("toks", tokens(F.col("text"))).select("item_id", _text_key(F.col("text")).alias("item_key"), "toks")
    items = items.dropDuplicates(["item_id", "item_key"]).where(F.size("toks") >= LEAST).withColumn("plain", plain(F.col("toks")))
    forms = F.array(*[
        F.struct(F.lit(form).alias("form"), F.col(read).alias("read"), _windows(_reduced(F.col(read), form)).alias("hashes"), _windows(F.col("plain")).alias("values"))
        for form, read in ((TEMPLATE, "toks"), (PLAIN, "plain"), (OPEN, "toks"))
    ])
    formed = items.select("item_id", "item_key", "toks", F.explode(forms).alias("f"))
    placed = formed.select("item_id", "item_key", "toks", "f.form", "f.read", "f.values", F.posexplode("f.hashes").alias("place", "hash"))
    literal = F.size(F.filter(F.slice("read", F.col("place") + 1, F.lit(WINDOW)), lambda t: (t >= _WORDS_FROM) | ((F.col("form") == TEMPLATE) & t.startswith("\u0004"))))
    chosen = F.when(literal >= LITERALS, F.col("hash")).when(F.col("form") == PLAIN, F.get("values", F.col("place")))
    kept = placed.withColumn("hash", chosen).where("hash IS NOT NULL").drop("read", "values")
    return kept.withColumn("windows", F.count("*").over(W.partitionBy("item_id", "item_key", "form")))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per distinct (``doc_id``, text) and benchmark item it holds.

    Columns: ``doc_id``, ``text_key`` (hash of the text), ``item_id``,
    ``item_windows``, ``held_windows``, ``containment``, ``slot_values``,
    ``slot_consistency``.  Null and empty texts hold nothing, nor are items
    of fewer than three tokens looked for; null ids are reported as null; repeated rows
    are reported once; empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        index = scratch.write(benchmark_windows(benchmark), "benchmark-windows")
        looked_for = index.select("item_id", "item_key", "form", F.col("place").alias("item_place"), F.col("windows").alias("item_windows"), "hash")
        if index.count() <= BROADCAST_WINDOWS:
            looked_for = F.broadcast(looked_for)
        rows = needed(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
        read = rows.select("doc_id", _text_key(F.col("text")).alias("text_key"), tokens(F.col("text")).alias("toks"))
        short = [r["n"] for r in index.select(F.size("toks").alias("n")).where(F.col("n") < WINDOW).distinct().orderBy("n").collect()]
        met = _probes(read, [WINDOW, *short]).join(looked_for, "hash").select("doc_id", "text_key", "item_id", "item_key", "form", "item_windows", "item_place", (F.col("place") - F.col("item_place")).alias("shift"))
        # equal rows fold here, so a place counts once however often its document is there
        hits = scratch.write(met.groupBy("doc_id", "text_key", "item_id", "item_key", "form", "item_windows", "item_place", "shift").agg(F.lit(1).alias("one")).drop("one"), "window-hits")
        pair = ["doc_id", "text_key", "item_id", "item_key", "form", "item_windows"]
        held = hits.groupBy(*pair, "item_place").agg(F.lit(1).alias("one")).groupBy(*pair).agg(F.count("*").alias("held_windows"))
        runs = hits.groupBy(*pair, "shift").agg(F.count("*").alias("run")).groupBy(*pair).agg(F.max(F.struct("run", (-F.col("shift")).alias("back"))).alias("best"))
        best = held.withColumnRenamed("doc_id", "id").alias("h").join(
            runs.withColumnRenamed("doc_id", "id").alias("r"),
            F.expr("h.id <=> r.id AND h.text_key = r.text_key AND h.item_id <=> r.item_id AND h.item_key = r.item_key AND h.form = r.form"),
        ).select("h.*", F.col("r.best.run").alias("run"), (-F.col("r.best.back")).alias("shift"))
        enough = (F.col("held_windows") >= CONTAINED * F.col("item_windows")) | (F.col("run") >= RUN)
        candidates = scratch.write(best.where(enough), "candidates")
        return scratch.keep(_consistent(candidates, hits, rows, index), "leaks")


def _consistent(candidates: DataFrame, hits: DataFrame, rows: DataFrame, index: DataFrame) -> DataFrame:
    """The candidates whose slot values agree along their best alignment."""
    wanted = candidates.select(F.col("id").alias("want_id"), F.col("text_key").alias("want_key")).distinct()
    texts = rows.withColumn("text_key", _text_key(F.col("text")))
    texts = texts.join(wanted, F.expr("doc_id <=> want_id AND text_key = want_key"), "left_semi").dropDuplicates(["doc_id", "text_key"])
    doc_tokens = texts.select("doc_id", "text_key", tokens(F.col("text")).alias("doc_toks"))
    item_tokens = index.select("item_id", "item_key", "toks").dropDuplicates(["item_id", "item_key"])
    c, h, d, i = candidates.alias("c"), hits.alias("h"), doc_tokens.alias("d"), item_tokens.alias("i")
    same = "c.id <=> h.doc_id AND c.text_key = h.text_key AND c.item_id <=> h.item_id AND c.item_key = h.item_key AND c.form = h.form AND c.shift = h.shift"
    aligned = c.join(h, F.expr(same)).select("c.*", "h.item_place").groupBy("id", "text_key", "item_id", "item_key", "form", "shift").agg(F.collect_set("item_place").alias("places"))
    a = aligned.alias("a")
    both = a.join(d, F.expr("a.id <=> d.doc_id AND a.text_key = d.text_key")).join(i, F.expr("a.item_id <=> i.item_id AND a.item_key = i.item_key"))
    covered = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + (WINDOW - 1)))))
    inside = F.filter(covered, lambda p: p < F.size("toks"))
    is_plain = F.col("form") == PLAIN
    read = both.withColumns({c: F.when(is_plain, plain(F.col(c))).otherwise(F.col(c)) for c in ("toks", "doc_toks")})
    pairs = F.transform(inside, lambda p: F.struct(F.get("toks", p).alias("item_value"), F.get("doc_toks", p + F.col("shift")).alias("doc_value")))
    named = F.filter(pairs, lambda s: _is_slot(s["item_value"]) & ((F.col("form") == OPEN) | ~s["item_value"].startswith("\u0004")))
    slots = read.select("a.id", "a.text_key", "a.item_id", "a.item_key", "a.form", F.explode(named).alias("slot"))
    keys = ["id", "text_key", "item_id", "item_key", "form"]
    slots = slots.select(*keys, (~F.col("slot.item_value").startswith("\u0004")).alias("sure"), _word(F.col("slot.item_value")).alias("item_value"), _word(F.col("slot.doc_value")).alias("doc_value"))
    values = slots.groupBy(*keys, "item_value").agg(F.max("sure").alias("sure"), F.min("doc_value").alias("low"), F.max("doc_value").alias("high"))
    # a word that only opens sentences and is the same in both is no name
    values = values.where("sure OR low <> item_value OR high <> item_value")
    kept = values.groupBy(*keys).agg(F.count("*").alias("slot_values"), F.avg((F.col("low") == F.col("high")).cast("double")).alias("slot_consistency"))
    s = kept.alias("s")
    found = c.join(s, F.expr("c.id <=> s.id AND c.text_key = s.text_key AND c.item_id <=> s.item_id AND c.item_key = s.item_key AND c.form = s.form"), "left")
    contained = F.col("held_windows") / F.col("item_windows")
    facts = {
        "containment": contained, "first_form": -F.col("c.form"), "item_windows": F.col("c.item_windows"), "held_windows": F.col("c.held_windows"),
        "slot_values": F.coalesce("slot_values", F.lit(0)), "slot_consistency": F.coalesce("slot_consistency", F.lit(1.0)),
    }
    out = found.select(F.col("c.id").alias("doc_id"), "c.text_key", "c.item_id", "c.item_key", F.struct(*[v.alias(k) for k, v in facts.items()]).alias("f"))
    best = out.where(F.col("f.slot_consistency") >= CONSISTENT).groupBy("doc_id", "text_key", "item_id", "item_key").agg(F.max("f").alias("f"))
    return best.select("doc_id", "text_key", "item_id", *[f"f.{k}" for k in ("item_windows", "held_windows", "containment", "slot_values", "slot_consistency")])


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns are kept."""
    key, of, text_of = fresh(docs, "text_key"), "leak_id", "leak_key"
    found = leaks(docs, benchmark).select(F.col("doc_id").alias(of), F.col("text_key").alias(text_of)).distinct()
    keyed = docs.withColumn(key, _text_key(F.col("text")))
    same = F.col(f"d.{key}").eqNullSafe(F.col(f"l.{text_of}")) & F.col("d.doc_id").cast("long").eqNullSafe(F.col(f"l.{of}"))
    return keyed.alias("d").join(found.alias("l"), same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


@query("op1_benchmark_decontamination")
def op1_benchmark_decontamination(spark, sf_dir):
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
