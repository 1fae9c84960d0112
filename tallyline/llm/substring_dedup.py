"""Repeated passages by fixed-block anchors (operator 10).

A window of W words that occurs twice holds, in either place, a block that
starts at a multiple of A = (W + 1) // 2 words of its text.  So the blocks of
A words at those places are the index, every rolling window of A words probes
it, and only windows of W words around a hit can be repeats.  A hit grows by
comparing the W-word windows that hold it; neighbouring repeated windows merge
into maximal exact repeats.  Copies of one passage meet as equal hashes in a
count, never as pairs, so a passage shared by a third of all documents costs
what its own words cost.

Hashes travel packed: texts are dealt into chunks of a few megabytes, and a
chunk sends each bucket of hashes one sorted array and gets one bit per entry
back.  The number of chunks and of buckets follows the input; beyond a
terabyte their size grows with its root (at 100 TB a chunk has 40 MB of text,
a bucket the hashes of 120 MB).  Chunks lie in a bucketed table in the
warehouse while the call runs, so the texts are shuffled once.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm import words as w
from tallyline.llm.base import Scratch, needed, octets, query, schema, table
from tallyline.shipping import by_value

by_value(__name__)

U = np.uint64
WINDOW = 35
#: Bytes of text in a chunk, and of text whose hashes meet in one bucket.
CHUNK_BYTES, BUCKET_BYTES = 4 << 20, 12 << 20
#: Bytes of text in one task of the bucketed table.
TASK_BYTES = 24 << 20
#: Spark's limit of buckets in a table; beyond it a task holds more chunks, one after another.
MOST_BUCKETS = 100_000
#: Input from which chunks and buckets grow, by the root of the input, so that a packed array keeps holding several hashes.
GROWS_FROM = 1 << 40
RESULT = "doc_id string, n_words long, n_removed long, kept_sha256 string"


def anchor_size(window: int) -> int:
    return (window + 1) // 2


def sizes(total: int) -> tuple[int, int, int]:
    """Chunks, buckets of hashes and buckets of the chunks' table for ``total`` bytes of text."""
    grown = max(1.0, math.sqrt(total / GROWS_FROM))
    count = lambda size: max(1, math.ceil(total / size))
    return count(CHUNK_BYTES * grown), count(BUCKET_BYTES * grown), min(max(8, count(TASK_BYTES)), MOST_BUCKETS)


def _chunk_blocks(texts: list) -> Iterator[tuple[int, w.Block, np.ndarray]]:
    for first, raws in w.blocks(texts):
        block = w.Block(raws)
        yield first, block, block.word_hashes()


def _fold(values: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values; flags of equal values or-ed, bit 0 set where a value is there twice."""
    order = np.argsort(values, kind="stable")
    values, flags = values[order], flags[order]
    head = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.empty(0, np.int64)
    if not len(head):
        return values, flags
    many = np.diff(np.append(head, len(values))) > 1
    return values[head], np.bitwise_or.reduceat(flags, head) | many.astype(flags.dtype)


def _anchor_values(block: w.Block, hashes: np.ndarray, size: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows of ``size`` words start, and bucket << 32 | 30 bits of hash << 2 of each."""
    at = block.windows(size)
    h = w.rolling(hashes, size, w.BASES[1])[at]
    return at, ((h >> U(34)) % U(buckets)) << U(32) | (h & U(0x3FFFFFFF)) << U(2)


def _anchors(texts: list, size: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The chunk's distinct window hashes with flags: 1 there twice, 2 a block of the index."""
    values, flags = [], []
    for _, block, hashes in _chunk_blocks(texts):
        at, v = _anchor_values(block, hashes, size, buckets)
        values.append(v)
        flags.append(((block.place[at] % size == 0) * 2).astype(np.uint8))
    if not values:
        return np.empty(0, U), np.empty(0, np.uint8)
    return _fold(np.concatenate(values), np.concatenate(flags))


def _by_bucket(buckets_of: np.ndarray) -> Iterator[tuple[int, slice]]:
    head = np.flatnonzero(np.concatenate(([True], buckets_of[1:] != buckets_of[:-1]))) if len(buckets_of) else []
    for s, e in zip(head, [*head[1:], len(buckets_of)]):
        yield int(buckets_of[s]), slice(int(s), int(e))


def _pack(chunk: int, values: np.ndarray, flags: np.ndarray, dtype) -> pd.DataFrame:
    """A row per bucket: its low halves, sorted, as one array."""
    rows = [
        (bucket, chunk, ((values[part] & U(0xFFFFFFFF)) | flags[part].astype(U)).astype(dtype).tobytes())
        for bucket, part in _by_bucket((values >> U(32)).astype(np.int64))
    ]
    return pd.DataFrame(rows, columns=["bucket", "chunk", "packed"])


def _meet(pdf: pd.DataFrame, key_bits: int, dtype, need_index: bool) -> pd.DataFrame:
    """Of one bucket: a bit per entry of every chunk, set where its value occurs twice in all."""
    parts = [np.frombuffer(p, dtype) for p in pdf["packed"]]
    entries = np.concatenate(parts)
    keys, flags = entries >> dtype(key_bits), entries & dtype((1 << key_bits) - 1)
    order = np.argsort(keys, kind="stable")
    ks, fs = keys[order], flags[order]
    head = np.flatnonzero(np.concatenate(([True], ks[1:] != ks[:-1])))
    count = np.diff(np.append(head, len(ks)))
    either = np.bitwise_or.reduceat(fs, head)
    hit = (count > 1) | ((either & dtype(1)) > 0)
    if need_index:
        hit &= (either & dtype(2)) > 0
    bits = np.empty(len(ks), bool)
    bits[order] = np.repeat(hit, count)
    out, at = [], 0
    for (bucket, chunk), part in zip(zip(pdf["bucket"], pdf["chunk"]), parts):
        own = bits[at : at + len(part)]
        at += len(part)
        if own.any():
            out.append((chunk, bucket, np.packbits(own).tobytes()))
    return pd.DataFrame(out, columns=["chunk", "bucket", "bits"])


def _hit_values(values: np.ndarray, buckets_of: np.ndarray, masks: pd.DataFrame) -> np.ndarray:
    """The values whose bit is set; values without a mask have none."""
    if not len(masks):
        return values[:0]
    mask = dict(zip(masks["bucket"], masks["bits"]))
    keep = [
        values[part][np.unpackbits(np.frombuffer(mask[bucket], np.uint8), count=part.stop - part.start).astype(bool)]
        for bucket, part in _by_bucket(buckets_of) if bucket in mask
    ]
    return np.concatenate(keep) if keep else values[:0]


def _among(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


def _candidates(texts: list, masks: pd.DataFrame, window: int, buckets: int) -> list[tuple]:
    """Per block: its place, word count and, for each window of W words around a hit, where it starts and its two hashes."""
    size = anchor_size(window)
    values, _ = _anchors(texts, size, buckets)
    hits = _hit_values(values, (values >> U(32)).astype(np.int64), masks)
    out = []
    for first, block, hashes in _chunk_blocks(texts):
        at, v = _anchor_values(block, hashes, size, buckets)
        struck = at[_among(v, hits)]
        near = w.covered(np.maximum(struck - (window - size), 0), window - size + 1, block.n) if block.n else np.empty(0, bool)
        starts = block.windows(window)
        starts = starts[near[starts]]
        one, two = (w.rolling(hashes, window, b)[starts] for b in w.BASES[1:])
        out.append((first, block, starts, one, two))
    return out


def _window_order(found: list[tuple], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (bucket, hash) of the candidates in order, with a flag where one is there twice."""
    one = np.concatenate([f[3] for f in found]) if found else np.empty(0, U)
    two = np.concatenate([f[4] for f in found]) if found else np.empty(0, U)
    bucket, key = (two >> U(20)) % U(buckets), one & ~U(3)
    order = np.lexsort((key, bucket))
    bucket, key = bucket[order], key[order]
    if not len(key):
        return bucket, key, np.empty(0, bool)
    head = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (bucket[1:] != bucket[:-1]))))
    return bucket[head], key[head], np.diff(np.append(head, len(key))) > 1


def _removal(pdf: pd.DataFrame, anchor_masks: pd.DataFrame, window_masks: pd.DataFrame, window: int, buckets: int) -> pd.DataFrame:
    texts = list(pdf["text"])
    found = _candidates(texts, anchor_masks, window, buckets)
    bucket, key, _ = _window_order(found, buckets)
    mask = dict(zip(window_masks["bucket"], window_masks["bits"]))
    repeated = {}
    for b, part in _by_bucket(bucket.astype(np.int64)):
        if b in mask:
            bits = np.unpackbits(np.frombuffer(mask[b], np.uint8), count=part.stop - part.start).astype(bool)
            repeated[b] = key[part][bits]
    n_words, n_removed, digests = [], [], []
    for _, block, starts, one, two in found:
        b, k = ((two >> U(20)) % U(buckets)).astype(np.int64), one & ~U(3)
        struck = np.zeros(len(starts), bool)
        order = np.argsort(b, kind="stable")
        for bucket_id, part in _by_bucket(b[order]):
            if bucket_id in repeated:
                rows = order[part]
                struck[rows] = _among(k[rows], repeated[bucket_id])
        gone = w.covered(starts[struck], window, block.n) if block.n else np.empty(0, bool)
        raw = block.buf.tobytes()
        for t, (a, n) in enumerate(zip(block.first, block.count)):
            lost = int(gone[a : a + n].sum())
            n_words.append(int(n))
            n_removed.append(lost)
            if lost:
                kept = np.flatnonzero(~gone[a : a + n]) + a
                text = b" ".join([raw[s:e] for s, e in zip(block.start[kept].tolist(), block.end[kept].tolist())])
            else:
                text = b" ".join(block.raws[t].split())
            digests.append(hashlib.sha256(text).hexdigest())
    return pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": n_words, "n_removed": n_removed, "kept_sha256": digests})


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): words, removed words and the digest of the words kept.

    A word goes if a window of ``window`` words over it has a word sequence
    that also starts anywhere else, in the same text too.  Words are case
    sensitive runs outside ``20 09-0D``.  A null or empty text has no words
    and the digest of the empty string; a null or repeated ``doc_id`` is a row
    like any other (equal rows remove each other's windows); no rows give no
    rows; other columns are not read.
    """
    spark = docs.sparkSession
    size = anchor_size(window)
    with Scratch(spark) as scratch:
        # ids travel as text: a null among them must not turn the others into floats
        rows = needed(docs, "doc_id", "text").select(F.col("doc_id").cast("string"), "text")
        total = octets(rows)
        chunks, buckets, tasks = sizes(total)
        dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
        texts = scratch.write_bucketed(dealt, "passages", tasks, "chunk")

        def anchors(key, pdf):
            values, flags = _anchors(list(pdf["text"]), size, buckets)
            return _pack(key[0], values, flags, np.uint32)

        def windows(key, pdf, masks):
            if not len(pdf):
                return pd.DataFrame({"bucket": [], "chunk": [], "packed": []})
            bucket, value, twice = _window_order(_candidates(list(pdf["text"]), masks, window, buckets), buckets)
            entries = value | twice.astype(U)
            packed = [(b, key[0], entries[part].tobytes()) for b, part in _by_bucket(bucket.astype(np.int64))]
            return pd.DataFrame(packed, columns=["bucket", "chunk", "packed"])

        def removal(key, pdf, masks):
            return _removal(pdf, masks[masks["kind"] == 0], masks[masks["kind"] == 1], window, buckets)

        packed, bits = schema("bucket long, chunk long, packed binary"), schema("chunk long, bucket long, bits binary")
        probes = texts.groupBy("chunk").applyInPandas(anchors, packed)
        hits = scratch.write(probes.groupBy("bucket").applyInPandas(lambda pdf: _meet(pdf, 2, np.uint32, True), bits), "anchor-hits")
        held = texts.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInPandas(windows, packed)
        repeats = scratch.write(held.groupBy("bucket").applyInPandas(lambda pdf: _meet(pdf, 2, U, False), bits), "repeats")
        masks = hits.withColumn("kind", F.lit(0)).unionByName(repeats.withColumn("kind", F.lit(1)))
        done = texts.groupBy("chunk").cogroup(masks.groupBy("chunk")).applyInPandas(removal, schema(RESULT))
        return scratch.keep(done.withColumn("doc_id", F.col("doc_id").cast("long")), "without-repeats")


OP10_SQL = f"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{r"[\x20\x09-\x0D]+"}'), lambda x: x <> '') AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 1)::BIGINT)) AS s FROM words WHERE len(w) >= {WINDOW}
), windows AS (
  SELECT doc_id, s, hash(array_to_string(w[s:s + {WINDOW - 1}], ' ')) AS h, md5(array_to_string(w[s:s + {WINDOW - 1}], ' ')) AS m FROM starts
), twice AS (
  SELECT h, m FROM windows GROUP BY h, m HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + {WINDOW})) AS p FROM windows JOIN twice USING (h, m)
), per AS (
  SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ') ELSE
    array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(ps, i)), lambda i: w[i]), ' ') END) AS kept_sha256
FROM words LEFT JOIN per USING (doc_id)
"""


@query("op10_substring_dedup", OP10_SQL)
def op10_substring_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"))
