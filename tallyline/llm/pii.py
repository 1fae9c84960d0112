"""Personal data by pattern, candidate spans and boosted trees (operator 9).

Base kinds are patterns with checks.  Beyond them, loose generators propose
number-like and address-like spans; each is described by its format and the
text before it, in a few small integers.  Counting every combination of these
over the corpus gives a bounded table on which depth-two trees are boosted,
with the base kinds as examples; the trees become one column expression, and a
threshold calibrated on a held-out fold selects further spans.

Offsets without Python: pieces between matches and the matches themselves, in
turn, cover the text, so their running length places every match.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.base import FOLDS, HELD_OUT, Scratch, fresh, needed, query, table

#: Patterns of the base kinds, in output order.  Possessive repeats and the anchors before
#: them only save time: what they rule out cannot begin or extend a match.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this cannot hold the kind.
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: Loose generators of candidates and the least digits of a number-like one.
LOOSE = {
    "number": r"[+(]?[0-9](?:[\x20().\x2F-]{0,2}[0-9])++",
    "address": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20?(?:@|\(at\)|\[at\])\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20dot\x20)[A-Za-z0-9-]++)*+",
}
LEAST_DIGITS = 7
ROUNDS, RATE, PRECISION = 30, 0.3, 0.9
CONTEXT = 24

# fixed values: words that announce personal data, by kind
HINTS = ("tel", "phone", "call", "fax", "mobil", "mail", "contact", "card", "visa", "iban", "ssn", "passport", "account", "ip ", "server", "host")

_SPAN = "array<struct<start:int,end:int,value:string>>"


def _starts(lengths: Column, step: int = 256) -> Column:
    """Exclusive running sums of an array of int, in blocks so that long arrays stay cheap."""
    zero = F.lit(0)
    add = lambda a, x: a + x

    def blocks(own):
        n = F.size(own)
        sums = F.transform(F.sequence(zero, n - 1, F.lit(step)), lambda k: F.aggregate(F.slice(own, k + 1, F.lit(step)), zero, add))

        def place(totals):
            def block(k):
                base = F.array(F.aggregate(F.slice(totals, F.lit(1), k), zero, add))
                size = F.least(F.lit(step), n - k * step)
                inner = lambda b: F.transform(F.sequence(zero, size - 1), lambda i: b + F.aggregate(F.slice(own, k * step + 1, i), zero, add))
                return F.flatten(F.transform(base, inner))

            return F.flatten(F.transform(F.sequence(zero, F.size(totals) - 1), block))

        return F.flatten(F.transform(F.array(sums), place))

    return F.when(F.size(lengths) == 0, F.array().cast("array<int>")).otherwise(F.flatten(F.transform(F.array(lengths), blocks)))


def _find(df: DataFrame, name: str, pattern: str, possible: Column) -> DataFrame:
    """``df`` with array ``name`` of the pattern's leftmost matches: ``start``, ``end`` (code points), ``value``."""
    values, gaps = f"{name}_values", f"{name}_gaps"
    none = F.array().cast("array<string>")
    df = df.withColumn(values, F.when(possible, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    pieces = F.split("text", pattern, -1)
    between = F.transform(F.slice(pieces, F.lit(1), F.size(values)), lambda p: F.length(p))
    df = df.withColumn(gaps, F.when(F.size(values) > 0, between).otherwise(F.array().cast("array<int>")))
    steps = F.zip_with(gaps, F.transform(values, lambda v: F.length(v)), lambda g, v: g + v)
    df = df.withColumn(f"{name}_starts", _starts(steps))
    parts = F.transform(
        F.arrays_zip(F.col(f"{name}_starts").alias("before"), F.col(gaps).alias("gap"), F.col(values).alias("value")),
        lambda z: F.struct((z["before"] + z["gap"]).alias("start"), (z["before"] + z["gap"] + F.length(z["value"])).alias("end"), z["value"].alias("value")),
    )
    out = F.when(F.size(values) > 0, parts).otherwise(F.array().cast(_SPAN))
    return df.withColumn(name, out).drop(values, gaps, f"{name}_starts")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total, i):
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


def _checked(kind: str):
    return lambda s: _valid(kind, s["value"])


def base_spans(df: DataFrame) -> DataFrame:
    """``df`` (with ``text``, never null) and an array per base kind."""
    for kind, pattern in BASE.items():
        need = _NEEDS[kind]
        possible = F.contains(F.col("text"), F.lit(need)) if need else F.lit(True)
        if kind != "email":
            possible = possible & F.col("text").rlike("[0-9]")
        df = _find(df, f"all_{kind}", pattern, possible)
        df = df.withColumn(kind, F.filter(f"all_{kind}", _checked(kind))).drop(f"all_{kind}")
    return df


#: Features of a candidate: name, and the number of values it takes.
FEATURES = {"digits": 8, "plus": 2, "bracket": 2, "groups": 5, "dots": 3, "dashes": 3, "blanks": 3, "luhn": 2, "hinted": 2, "glued": 2, "at": 2}


def _features(s: Column) -> list[Column]:
    value, before = s["value"], s["before"]
    digits = _digits(value)
    n = F.length(digits)
    count = lambda c: F.length(value) - F.length(F.replace(value, F.lit(c), F.lit("")))
    level = F.when(n < 1, 0).when(n < 7, 1).when(n < 9, 2).when(n < 11, 3).when(n < 13, 4).when(n < 16, 5).when(n < 20, 6).otherwise(7)
    hint = F.lit(False)
    for word in HINTS:
        hint = hint | F.contains(before, F.lit(word))
    flag = lambda c: c.cast("int")
    return [
        level.alias("digits"), flag(F.startswith(value, F.lit("+"))).alias("plus"), flag(F.contains(value, F.lit("("))).alias("bracket"),
        F.least(F.size(F.split(value, "[^0-9]+")), F.lit(4)).alias("groups"), F.least(count("."), F.lit(2)).alias("dots"),
        F.least(count("-"), F.lit(2)).alias("dashes"), F.least(count(" "), F.lit(2)).alias("blanks"),
        flag(F.when(n.between(12, 19), _luhn(digits)).otherwise(False)).alias("luhn"), flag(hint).alias("hinted"),
        flag(before.rlike(r"[\p{L}\p{N}_=]$")).alias("glued"), flag(F.contains(value, F.lit("@"))).alias("at"),
    ]


def candidate_spans(df: DataFrame) -> DataFrame:
    """``df`` of :func:`base_spans` with ``candidates``: spans, their features, and whether a base span overlaps."""
    for name, pattern in LOOSE.items():
        possible = F.col("text").rlike("[0-9]") if name == "number" else F.col("text").rlike(r"@|\(at\)|\[at\]")
        df = _find(df, name, pattern, possible)
    enough = F.filter("number", lambda s: F.length(_digits(s["value"])) >= LEAST_DIGITS)
    df = df.withColumn("loose", F.concat(enough, F.col("address"))).drop("number", "address")
    df = df.withColumn("base", F.concat(*[F.col(k) for k in BASE]))

    def seen(s):
        before = F.lower(F.substring(F.col("text"), F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT))))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), before.alias("before"))

    def described(s):
        known = F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), known.alias("known"), *_features(s))

    df = df.withColumn("seen", F.transform("loose", seen)).drop("loose")
    return df.withColumn("candidates", F.transform("seen", described)).drop("seen", "base")


@dataclass(frozen=True)
class Leaf:
    value: float

    def column(self, of) -> Column:
        return F.lit(self.value)

    def at(self, row: dict) -> float:
        return self.value


@dataclass(frozen=True)
class Split:
    feature: str
    cut: int
    below: Leaf | Split
    above: Leaf | Split

    def column(self, of) -> Column:
        return F.when(of(self.feature) < self.cut, self.below.column(of)).otherwise(self.above.column(of))

    def at(self, row: dict) -> float:
        return (self.below if row[self.feature] < self.cut else self.above).at(row)


@dataclass(frozen=True)
class Trees:
    """``start`` plus the trees is the log-odds of personal data; spans from ``threshold`` on are taken."""

    start: float = 0.0
    trees: tuple = ()
    threshold: float = math.inf

    def column(self, of) -> Column:
        total = F.lit(self.start)
        for tree in self.trees:
            total = total + tree.column(of)
        return total

    def at(self, row: dict) -> float:
        return self.start + sum(tree.at(row) for tree in self.trees)


def _grow(rows: list[dict], depth: int) -> Leaf | Split:
    """Newton tree on weighted rows with gradient ``g`` and curvature ``h``."""
    g, h = sum(r["g"] for r in rows), sum(r["h"] for r in rows)
    leaf, best, chosen = Leaf(RATE * g / (h + 1.0)), 1e-6, None
    if depth:
        for name, levels in FEATURES.items():
            for cut in range(1, levels):
                left = [r for r in rows if r[name] < cut]
                if left and len(left) < len(rows):
                    gl, hl = sum(r["g"] for r in left), sum(r["h"] for r in left)
                    gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                    if gain > best:
                        best, chosen = gain, (name, cut)
    if chosen is None:
        return leaf
    name, cut = chosen
    return Split(name, cut, _grow([r for r in rows if r[name] < cut], depth - 1), _grow([r for r in rows if r[name] >= cut], depth - 1))


def boost(combinations: list[dict]) -> Trees:
    """Trees from rows of features with ``n``, ``known`` and ``held`` (the calibrating fold); one kind only learns nothing."""
    train = [dict(r) for r in combinations if not r["held"]]
    yes, no = sum(r["known"] for r in train), sum(r["n"] - r["known"] for r in train)
    if not yes or not no:
        return Trees()
    start, trees = math.log(yes / no), []
    for r in train:
        r["f"] = start
    for _ in range(ROUNDS):
        for r in train:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, r["f"]))))
            r["g"], r["h"] = r["known"] - r["n"] * p, r["n"] * p * (1 - p)
        tree = _grow(train, 2)
        trees.append(tree)
        for r in train:
            r["f"] += tree.at(r)
    model = Trees(start, tuple(trees))
    held = sorted(((model.at(r), r["known"], r["n"]) for r in combinations if r["held"]), reverse=True)
    threshold, good, all_ = math.inf, 0, 0
    for k, (score, known, n) in enumerate(held):
        good, all_ = good + known, all_ + n
        if (k + 1 == len(held) or held[k + 1][0] < score) and good >= PRECISION * all_:
            threshold = score
    return Trees(start, tuple(trees), threshold)


def fit(docs: DataFrame) -> Trees:
    """Trees from the candidates of all documents."""
    prepared = _prepare(docs)
    fold = (F.pmod(F.xxhash64("text"), F.lit(FOLDS)) == HELD_OUT).alias("held")
    spans = candidate_spans(base_spans(prepared)).select(fold, F.explode("candidates").alias("c"))
    counts = spans.groupBy("held", *[F.col(f"c.{f}").alias(f) for f in FEATURES]).agg(F.count("*").alias("n"), F.sum(F.col("c.known").cast("long")).alias("known"))
    # the features bound the rows, so all are taken
    rows = [r.asDict() for r in counts.orderBy("held", *FEATURES).collect()]
    return boost(rows)


def _prepare(docs: DataFrame) -> DataFrame:
    return needed(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))


def spans(prepared: DataFrame, model: Trees) -> DataFrame:
    """Rows with the arrays of the base kinds and ``other``, the candidates the trees take."""
    df = candidate_spans(base_spans(prepared))
    chosen = F.filter("candidates", lambda s: ~s["known"] & (model.column(lambda name: s[name]) >= model.threshold)) if math.isfinite(model.threshold) else F.slice("candidates", 1, 0)
    return df.withColumn("other", F.array_sort(F.transform(chosen, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))).drop("candidates")


def _named(kind: str) -> Column:
    return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def find(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: counts of the base kinds, their digest, and all spans as text.

    Added spans are of kind ``other`` and never overlap a base span.  Null and
    empty texts hold nothing; null and repeated ids are rows like any other;
    no rows give no rows; other columns are not read.
    """
    found = spans(_prepare(docs), fit(docs))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in BASE]
    base = F.concat(*[_named(k) for k in BASE])
    return found.select("doc_id", *counts, base.alias("base"), _named("other").alias("more")).select(
        "doc_id", *[f"n_{k}" for k in BASE], F.sha2(F.array_join("base", ","), 256).alias("base_sha256"), F.array_join(F.concat("base", "more"), ",").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by its kind in brackets; null stays null, all columns are kept."""
    model, held = fit(docs), fresh(docs, "row_of_doc")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(held), F.col("text").isNull().alias("no_text"), F.coalesce("text", F.lit("")).alias("text"))
    df = spans(packed, model)

    def masked(kind):
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(f"[{kind.upper()}]").alias("mask")))

    marked = [masked(kind) for kind in (*BASE, "other")]
    df = df.withColumn("marks", F.array_sort(F.concat(*marked)))

    def step(acc, s):
        keep = F.substring(F.col("text"), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        more = F.struct(F.concat(acc["out"], keep, s["mask"]).alias("out"), s["end"].alias("at"))
        return F.when(s["end"] <= acc["at"], acc).otherwise(more)

    done = F.aggregate("marks", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step)
    df = df.withColumn("done", F.when(F.size("marks") > 0, done))
    tail = F.substring(F.col("text"), F.col("done.at") + 1, F.length("text"))
    clean = F.when(F.col("no_text"), F.lit(None).cast("string")).when(F.size("marks") > 0, F.concat(F.col("done.out"), tail)).otherwise(F.col("text"))
    # written, as whoever reads the text on would expand this expression at every use
    with Scratch(docs.sparkSession) as scratch:
        return scratch.keep(df.select(*[clean.alias(c) if c == "text" else F.col(f"{held}.`{c}`") for c in docs.columns]), "redacted")


@query("op9_pii_spans")
def op9_pii_spans(spark, sf_dir):
    return find(table(spark, sf_dir, "documents"))
