"""Spelling variants by Bloom-guided neighbourhoods (operator 12).

Every word of the vocabulary generates its edits (deletions, and replacements
by a larger letter: a pair differs by a deletion seen from its longer word, or
by a replacement seen from its smaller one, so half of all edits find every
pair).  Edits are hashed without being spelled out and probe blocked Bloom
filters, one per word length, that the tasks hold; only edits a filter answers
for are spelled and meet the vocabulary in an exact join.  Words of the pattern
are Latin-1, so a word is an array of bytes.

Filters of at most :data:`FILTER_BYTES` are broadcast at a time; a larger
vocabulary takes several passes, each with the filters of some lengths or of
some slices of a length, so what is broadcast does not grow with the data.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.base import Scratch, needed, query, table
from tallyline.shipping import by_value

by_value(__name__)

RUN = "[A-Za-zÀ-ÿ]+"
#: One run in so many loses a letter; which ones follows from document and word.
TYPO_EVERY = 199
LEAST_LENGTH, LEAST_COUNT, FORM_TIMES = 6, 5, 5
#: Bits a word has in its filter, probes of a word, 64-bit cells of a block.
BITS_A_WORD, PROBES, CELLS = 16, 5, 8
#: Bytes of the filters one pass broadcasts, and of one slice of a length.
FILTER_BYTES = 32 << 20
#: Edits hashed at a time.
EDITS_AT_ONCE = 1 << 20

_BASE = 0x9E3779B97F4A7C15


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n + 1, np.uint64(_BASE))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def letters(words: list[bytes]) -> np.ndarray:
    """Words of one length as rows of letters."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def word_hash(rows: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row of letters, not mixed, so that edits can be added to it."""
    return (rows.astype(np.uint64) * _powers(rows.shape[1])[: rows.shape[1]]).sum(axis=1, dtype=np.uint64)


def bloom_place(h: np.ndarray, blocks: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Block of each hash, and (cell of the block, bit of the cell) of every probe."""
    first, bits = _mixed(h), _mixed(h ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    block = ((first >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    probes = []
    for k in range(PROBES):
        own = bits >> np.uint64(9 * k)
        probes.append(((own >> np.uint64(6)) & np.uint64(CELLS - 1), own & np.uint64(63)))
    return block.astype(np.int64), probes


def slice_of(h: np.ndarray, slices: int) -> np.ndarray:
    return (_mixed(h ^ np.uint64(0x5C5C5C5C5C5C5C5C)) % np.uint64(slices)).astype(np.int64)


class Filters:
    """``shards``: (length, slice) to (number of slices of that length, cells of the filter)."""

    def __init__(self, shards: dict) -> None:
        self.shards = shards

    def maybe(self, h: np.ndarray, length: int) -> np.ndarray:
        """False where no vocabulary word of that length, in the slices held, has this hash."""
        found = np.zeros(len(h), bool)
        for (size, own), (slices, cells) in self.shards.items():
            if size != length:
                continue
            here = np.arange(len(h)) if slices == 1 else np.flatnonzero(slice_of(h, slices) == own)
            block, probes = bloom_place(h[here], len(cells) // CELLS)
            yes = np.ones(len(here), bool)
            for cell, bit in probes:
                yes &= (cells[block * CELLS + cell.astype(np.int64)] >> bit) & np.uint64(1) == 1
            found[here] |= yes
        return found


def edits_met(rows: np.ndarray, alphabet: np.ndarray, filters: Filters) -> tuple[np.ndarray, list[bytes]]:
    """(row, spelled edit) of every deletion and upward replacement that a filter answers for."""
    n, length = rows.shape
    power = _powers(length)
    values = rows.astype(np.uint64) * power[:length]
    whole = values.sum(axis=1, dtype=np.uint64)
    before = np.cumsum(values, axis=1, dtype=np.uint64) - values
    back = np.uint64(pow(_BASE, -1, 1 << 64))
    source, spelled = [], []
    for at in range(length):
        # what follows the deleted letter moves one place towards the front
        gone = before[:, at] + (whole - before[:, at] - values[:, at]) * back
        if at:
            # the first letter of a run of equal ones stands for all
            gone_rows = np.flatnonzero(rows[:, at] != rows[:, at - 1])
        else:
            gone_rows = np.arange(n)
        hit = gone_rows[filters.maybe(gone[gone_rows], length - 1)] if length > 1 else gone_rows[:0]
        source.append(hit)
        spelled.extend(np.delete(rows[hit], at, axis=1).tobytes()[k * (length - 1) : (k + 1) * (length - 1)] for k in range(len(hit)))
        # replacements by every larger letter, in pieces of bounded size
        for first in range(0, n, max(EDITS_AT_ONCE // len(alphabet), 1)):
            own = np.arange(first, min(first + max(EDITS_AT_ONCE // len(alphabet), 1), n))
            row, letter = np.nonzero(alphabet[None, :] > rows[own, at][:, None])
            row, new = own[row], alphabet[letter]
            h = whole[row] + (new.astype(np.uint64) - rows[row, at].astype(np.uint64)) * power[at]
            met = np.flatnonzero(filters.maybe(h, length))
            made = rows[row[met]].copy()
            made[:, at] = new[met]
            source.append(row[met])
            spelled.extend(made[k].tobytes() for k in range(len(met)))
    return np.concatenate(source), spelled


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` of all words that are long and frequent enough, after the contract's deletions."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rows = needed(docs, "doc_id", "text").where("text IS NOT NULL")
    owner = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("owner")
    runs = rows.select(owner, F.explode(F.regexp_extract_all(F.translate("text", upper, upper.lower()), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= LEAST_LENGTH).withColumn("h", F.crc32(F.concat_ws(":", "owner", "run").cast("binary")))
    shorter = F.expr("CONCAT(SUBSTRING(run, 1, CAST(h % LENGTH(run) AS INT)), SUBSTRING(run, CAST(h % LENGTH(run) AS INT) + 2))")
    words = runs.select(F.when(F.col("h") % TYPO_EVERY == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _hashes(words: DataFrame) -> DataFrame:
    """``length`` and unmixed hash ``h`` of every word."""

    def run(batches):
        for batch in batches:
            raw = np.array([w.encode("latin-1") for w in batch.column(0).to_pylist()], object)
            sizes = np.array([len(w) for w in raw], np.int64)
            h = np.zeros(len(raw), np.uint64)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                h[own] = word_hash(letters(list(raw[own])))
            yield pa.RecordBatch.from_arrays([pa.array(sizes), pa.array(h.view(np.int64))], ["length", "h"])

    return words.select("word").mapInArrow(run, "length long, h long")


def plan_shards(counts: dict[int, int], budget: int = FILTER_BYTES) -> list[dict[tuple[int, int], tuple[int, int]]]:
    """Passes; each maps (length, slice) to (slices of the length, blocks of the filter) within ``budget`` bytes."""
    passes, now, used, block = [], {}, 0, CELLS * 8
    for length, n in sorted(counts.items()):
        size = max(-(-n * BITS_A_WORD // (8 * block)), 1) * block
        slices = -(-size // budget)
        for own in range(slices):
            blocks = max(-(-size // slices // block), 1)
            if now and used + blocks * block > budget:
                passes.append(now)
                now, used = {}, 0
            now[(length, own)] = (slices, blocks)
            used += blocks * block
    return passes + ([now] if now else [])


def build_filters(hashes: DataFrame, plan: dict) -> Filters:
    """The filters of one pass; tasks send set bits by cell, folded map-side, and the sum is bounded by the plan."""

    def fold(batches):
        for batch in batches:
            size, h = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            out = {"length": [], "own": [], "cell": [], "bits": []}
            for (length, own), (slices, blocks) in plan.items():
                here = h[size == length]
                here = here[slice_of(here, slices) == own] if slices > 1 else here
                block, probes = bloom_place(here, blocks)
                for cell, bit in probes:
                    out["cell"].append(block * CELLS + cell.astype(np.int64))
                    out["bits"].append((np.uint64(1) << bit).view(np.int64))
                    out["length"].append(np.full(len(here), length))
                    out["own"].append(np.full(len(here), own))
            yield pa.RecordBatch.from_pydict({k: np.concatenate(v).astype(np.int64) for k, v in out.items()})

    if not plan:
        return Filters({})
    cells = hashes.mapInArrow(fold, "length long, own long, cell long, bits long").groupBy("length", "own", "cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    length, own, cell, bits = [cells.column(c).to_numpy() for c in ("length", "own", "cell", "bits")]
    shards = {}
    for (size, part), (slices, blocks) in plan.items():
        here = (length == size) & (own == part)
        made = np.zeros(blocks * CELLS, np.uint64)
        made[cell[here]] = bits[here].view(np.uint64)
        shards[(size, part)] = (slices, made)
    return Filters(shards)


def positives(words: DataFrame, alphabet: list[int], filters: Filters) -> DataFrame:
    """``word``, ``n`` and the spelled ``edit`` wherever a filter answers for it."""
    sent = words.sparkSession.sparkContext.broadcast(filters.shards)
    own_letters = np.array(alphabet, np.uint8)

    def run(batches):
        held = Filters(sent.value)
        for batch in batches:
            raw = np.array([w.encode("latin-1") for w in batch.column(0).to_pylist()], object)
            n, sizes = batch.column(1).to_numpy(), np.array([len(w) for w in raw], np.int64)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                row, spelled = edits_met(letters(list(raw[own])), own_letters, held)
                yield pa.RecordBatch.from_pydict({
                    "word": pa.array([w.decode("latin-1") for w in raw[own[row]]], pa.string()), "n": pa.array(n[own[row]]),
                    "edit": pa.array([w.decode("latin-1") for w in spelled], pa.string()),
                })

    return words.select("word", "n").mapInArrow(run, "word string, n long, edit string")


def near_pairs(words: DataFrame, scratch: Scratch, budget: int = FILTER_BYTES) -> DataFrame:
    """(``word``, ``n``, ``near``, ``near_n``) of all ordered pairs that differ by one edit."""
    counts = {r["length"]: r["n"] for r in words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).collect()}
    alphabet = [ord(r[0]) for r in words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''").distinct().collect()]
    hashes = scratch.write(_hashes(words), "word-hashes")
    met = [scratch.write(positives(words, sorted(alphabet), build_filters(hashes, plan)), "edits") for plan in plan_shards(counts, budget)]
    if not met:
        met = [words.select("word", "n", F.col("word").alias("edit")).limit(0)]
    exact = words.select(F.col("word").alias("edit"), F.col("n").alias("near_n"))
    pairs = reduce(DataFrame.unionByName, met).join(exact, "edit").select("word", "n", F.col("edit").alias("near"), "near_n")
    turned = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.unionByName(turned)


def _followed(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word`` and ``root``: forms followed to the last, twice as far each round."""
    now = scratch.write(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = scratch.write(now.join(ahead, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "roots")
        now = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return now


def group_variants(words: DataFrame, scratch: Scratch, budget: int = FILTER_BYTES) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of a vocabulary (``word``, ``n``)."""
    near = near_pairs(words, scratch, budget)
    # of the most frequent near words the first by code points
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    forms = words.join(best, "word", "left").withColumn("frequent", -F.col("best.less") >= FORM_TIMES * F.col("n"))
    forms = scratch.write(forms.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("frequent"), F.col("best.near")).alias("form"), F.when(F.col("frequent"), -F.col("best.less")).alias("form_n"),
    ), "forms")
    return forms.join(_followed(forms, scratch), "word").select("word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, budget: int = FILTER_BYTES) -> DataFrame:
    """A row per frequent word of ``docs`` (``doc_id``, ``text``) with its near words and root form.

    Null and empty texts have no words; a null ``doc_id`` counts as an empty
    id where letters are deleted; repeated rows count each time; texts of any
    length are read whole; of near words equally frequent the first in
    code-point order is the form; no rows give no rows; other columns are not
    read.  ``budget`` bounds the filters broadcast at a time, not the result.
    """
    with Scratch(docs.sparkSession) as scratch:
        words = scratch.write(vocabulary(docs), "vocabulary")
        return scratch.keep(group_variants(words, scratch, budget), "variants")


SPELLING_SQL = rf"""
WITH RECURSIVE crc AS (
    SELECT list(list_reduce(list_concat([i::BIGINT], list_transform(range(8), lambda k: k::BIGINT)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS row_of
    FROM range(256) AS t(i)),
runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS owner, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{RUN}')) AS run
    FROM documents),
spelled AS (SELECT run, hex(owner || ':' || run) AS digits FROM runs WHERE length(run) >= {LEAST_LENGTH}),
hashed AS (
    SELECT run, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(length(digits) // 2), lambda i:
        ((strpos('0123456789ABCDEF', digits[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', digits[2 * i + 2]) - 1)::BIGINT)),
        lambda c, b: xor(c >> 8, row_of[(xor(c, b) & 255) + 1])), 4294967295) AS h
    FROM spelled, crc),
said AS (SELECT CASE WHEN h % {TYPO_EVERY} = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, count(*) AS n FROM said WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING count(*) >= {LEAST_COUNT}),
cuts AS (SELECT DISTINCT word, n, spot, substring(word, 1, spot) || substring(word, spot + 2) AS cut FROM words, unnest(range(length(word))) AS t(spot)),
met AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.spot = b.spot AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
    UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k FROM met),
forms AS (
    SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.near_n >= {FORM_TIMES} * w.n THEN r.near END AS form, CASE WHEN r.near_n >= {FORM_TIMES} * w.n THEN r.near_n END AS form_n
    FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.k = 1),
steps AS (SELECT word, word AS root FROM forms WHERE form IS NULL UNION ALL SELECT f.word, s.root FROM forms f JOIN steps s ON f.form = s.word)
SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n FROM forms f JOIN steps s ON f.word = s.word
"""


@query("op12_spelling_variants", SPELLING_SQL)
def op12_spelling_variants(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"))
