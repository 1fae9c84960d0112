"""Quality verdicts by a learned decision list (operator 7).

Counts of every whole text are numpy passes over blocks of texts.  Rules come
from labelled rows: sequential covering grows conjunctions of threshold tests
by information gain on two thirds of them, prunes each on the rest, keeps it
only if it is precise there, and goes on with the rows it does not cover.  The
list becomes one Spark conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm import words as w
from tallyline.llm.base import Scratch, map_texts, needed, query, table
from tallyline.shipping import by_value

by_value(__name__)

#: Labelled rows the rules are fitted on, chosen by a hash of their id.
TRAIN_ROWS = 40_000
#: A rule has at most this many tests, and a list this many rules.
TESTS, RULES = 4, 16
#: Least share of rejected rows that must be bad, among the rows that prune a rule.
PRECISION = 0.9
CUTS = 32

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct")
#: What the tests look at: ratios, so that a rule means the same for short and long texts.
FEATURES = {
    "symbol_share": ("n_symbols", "word_chars"), "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"), "digit_share": ("n_digits", "word_chars"), "mark_share": ("n_marks", "n_words"),
    "word_length": ("word_chars", "n_words"), "distinct_share": ("n_distinct", "n_words"), "words_a_line": ("n_words", "n_lines"),
}
_CLASSES = {"n_symbols": b"#*$%&|<>", "n_upper": bytes(range(65, 91)), "n_digits": b"0123456789", "n_marks": b"!?"}


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


def _repeats(text: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row, whether (text, key) is there twice; per text, how many rows repeat an earlier one."""
    if not len(keys):
        return np.zeros(0, bool), np.zeros(n, np.int64)
    order = np.lexsort((keys, text))
    t, k = text[order], keys[order]
    head = np.concatenate(([True], (t[1:] != t[:-1]) | (k[1:] != k[:-1])))
    many = np.diff(np.append(np.flatnonzero(head), len(k)))
    twice = np.empty(len(k), bool)
    twice[order] = np.repeat(many > 1, many)
    return twice, np.bincount(t[~head], minlength=n)


def block_counts(raws: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of each text of a block."""
    block = w.Block(raws)
    n, buf = len(raws), block.buf
    per_text = lambda mask: np.add.reduceat(mask.astype(np.int64), block.offset)
    out = {name: per_text(_flags(chars)[buf]) for name, chars in _CLASSES.items()}
    gap = w._SPACE[buf]
    out["n_words"], out["word_chars"] = block.count.astype(np.int64), per_text(~gap & ((buf & 0xC0) != 0x80))
    hashes = block.word_hashes()
    _, same = _repeats(block.text, hashes, n)
    out["n_distinct"] = out["n_words"] - same
    at = block.windows(3)
    twice, _ = _repeats(block.text[at], w.rolling(hashes, 3, w.BASES[1])[at], n)
    again = w.covered(at[twice], 3, block.n) if block.n else np.zeros(0, bool)
    out["n_repeat_words"] = np.bincount(block.text[again], minlength=n)
    stop = np.flatnonzero(buf == 10)
    start = np.concatenate(([0], stop[:-1] + 1))
    full = np.searchsorted(block.start, stop) > np.searchsorted(block.start, start)
    start, stop = start[full], stop[full]
    owner = np.searchsorted(block.offset, start, side="right") - 1
    _, out["n_dup_lines"] = _repeats(owner, w.segment_hash(buf, start, stop) if len(start) else np.empty(0, np.uint64), n)
    out["n_lines"] = np.bincount(owner, minlength=n)
    return out


def text_counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and :data:`COUNTS` of every whole text; a null text counts as empty."""

    def count(texts):
        parts = [block_counts(raws) for _, raws in w.blocks(texts)]
        return {c: np.concatenate([p[c] for p in parts]) if parts else [] for c in COUNTS}

    rows = needed(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return map_texts(rows, lambda: count, ", ".join(f"{c} long" for c in COUNTS))


def feature(name: str) -> Column:
    above, below = FEATURES[name]
    return F.col(above) / F.greatest(F.col(below), F.lit(1))


@dataclass(frozen=True)
class Test:
    feature: str
    at_least: bool
    cut: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        own = values[self.feature]
        return own >= self.cut if self.at_least else own < self.cut

    def column(self) -> Column:
        return feature(self.feature) >= self.cut if self.at_least else feature(self.feature) < self.cut


Rule = tuple[Test, ...]


def _covers(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for test in rule:
        out &= test.holds(values)
    return out


def _grow(values: dict[str, np.ndarray], bad: np.ndarray, tests: list[Test]) -> Rule:
    """Add the test of most information gain until only bad rows are covered."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < TESTS and (inside & ~bad).any():
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        best, chosen = 1e-9, None
        for test in tests:
            both = inside & test.holds(values)
            p1 = int((both & bad).sum())
            if p1:
                gain = p1 * (math.log2(p1 / both.sum()) - math.log2(p / (p + n)))
                if gain > best:
                    best, chosen = gain, test
        if chosen is None:
            break
        rule = (*rule, chosen)
        inside &= chosen.holds(values)
    return rule


def _worth(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, int]:
    inside = _covers(rule, values, len(bad))
    p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
    return ((p - n) / (p + n) if p + n else -1.0), p


def learn_rules(values: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Ordered rules that reject; deterministic for given rows in given order."""
    cuts = {f: np.unique(np.quantile(v, np.linspace(0, 1, CUTS + 1)[1:])) if len(v) else [] for f, v in values.items()}
    tests = [Test(f, side, float(c)) for f in values for c in cuts[f] for side in (True, False)]
    rules: list[Rule] = []
    part = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), bool)
    while len(rules) < RULES:
        grow, prune = left & ~part, left & part
        if not (bad & grow).any():
            break
        rule = _grow({f: v[grow] for f, v in values.items()}, bad[grow], tests)
        held = {f: v[prune] for f, v in values.items()}
        best, found = _worth(rule, held, bad[prune])
        while len(rule) > 1 and _worth(rule[:-1], held, bad[prune])[0] >= best:
            rule = rule[:-1]
            best, found = _worth(rule, held, bad[prune])
        if not rule or not found or (best + 1) / 2 < PRECISION:
            break
        rules.append(rule)
        left &= ~_covers(rule, values, len(bad))
    return rules


def rejected(rules: list[Rule]) -> Column:
    """The list as one conditional expression over :data:`COUNTS`; no rules reject nothing."""
    if not rules:
        return F.lit(False)
    whole = None
    for rule in rules:
        test = rule[0].column()
        for more in rule[1:]:
            test = test & more.column()
        whole = F.when(test, True) if whole is None else whole.when(test, True)
    return whole.otherwise(False)


def fit(counts: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> list[Rule]:
    """Rules from ``labels`` (``doc_id``, ``quality``: 0 is bad) on about ``rows`` of the labelled texts."""
    marked = needed(labels, "doc_id", "quality").where("quality IS NOT NULL AND doc_id IS NOT NULL")
    total = marked.count()
    if not total:
        return []
    share = min(1.0, rows / total)
    some = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    known = counts.join(some, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
    found = known.select(*[feature(f).alias(f) for f in FEATURES], "quality").toPandas()
    return learn_rules({f: found[f].to_numpy(float) for f in FEATURES}, found["quality"].to_numpy() == 0)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs`` the counts, ``base_failed`` and ``kept``.

    A text fails the base rules with under 50 words, or when over half of its
    words lie in three-word windows it repeats; else the learned list decides.
    Null and empty texts have no words and fail.  Without labels, or with one
    kind only, nothing is learned and the base rules decide.  Null and
    repeated ids are rows like any other; no rows give no rows.
    """
    with Scratch(docs.sparkSession) as scratch:
        counts = scratch.write(text_counts(docs), "text-counts")
        rules = fit(counts, labels)
        failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
        out = counts.select("doc_id", *COUNTS[:5], failed.alias("base_failed"), (~failed & ~rejected(rules)).alias("kept"))
        return scratch.keep(out, "judged")


@query("op7_quality_rules")
def op7_quality_rules(spark, sf_dir):
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
