"""Secrets by pattern and by dictionary-primed compression (operator 4).

Base kinds are patterns.  Beyond them, long strings with a sensitive word
nearby are candidates.  A candidate's novelty is the bytes it adds when
zstandard, primed with the identifiers most frequent around candidates in the
whole corpus, compresses its surroundings with and without it; what does not
compress is reported as ``novel``.
"""

from __future__ import annotations

import hashlib
import re

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.base import Scratch, map_texts, needed, query, table
from tallyline.shipping import by_value

by_value(__name__)

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
# maximal runs, so the least length may stand in the pattern
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Any text with an assignment holds one of these in lower case.
_ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")

# fixed values: words that make their surroundings sensitive
SENSITIVE = (
    "password", "passwd", "pwd", "passphrase", "secret", "token", "apikey", "api_key", "api-key", "access_key", "private", "credential",
    "auth", "bearer", "signature", "cert", "login", "session", "jwt", "client_id", "encryption",
)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_SENSITIVE = re.compile("|".join(map(re.escape, SENSITIVE)))
#: Characters looked at on either side of a candidate; bytes a candidate must add, per character and in all.
AROUND, NOVELTY, LEAST_BYTES = 64, 0.55, 12
#: Identifiers in the dictionary, and its bytes.
IDENTIFIERS, DICTIONARY = 2000, 32 << 10
LEVEL = 9


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, sorted."""
    lowered = text.lower()
    out = []
    if any(h in lowered for h in _ASSIGN_HINTS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Long strings outside base spans with a sensitive word in reach, and their surroundings."""
    if not _SENSITIVE.search(text.lower()):
        return []
    out, taken = [], sorted((s, e) for s, _, e in base)
    k = 0
    for m in _CANDIDATE.finditer(text):
        s, e = m.span()
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        if any(a < e and s < b for a, b in taken[k : k + len(KINDS)]):
            continue
        before, after = text[max(0, s - AROUND) : s], text[e : e + AROUND]
        if _SENSITIVE.search((before + " " + after).lower()):
            out.append({"start": s, "end": e, "value": m[0], "before": before, "after": after})
    return out


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, base spans (``start``, ``kind``, ``end``) and candidates of every whole text."""

    def run(texts):
        base = [base_spans(t) if t else [] for t in texts]
        return {
            "base": [[{"start": s, "kind": k, "end": e} for s, k, e in own] for own in base],
            "found": [candidates(t, own) if t else [] for t, own in zip(texts, base)],
        }

    rows = needed(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    span = "array<struct<start:int,kind:int,end:int>>"
    return map_texts(rows, lambda: run, f"base {span}, found array<struct<start:int,end:int,value:string,before:string,after:string>>")


def identifiers(scanned: DataFrame) -> bytes:
    """The identifiers most frequent around candidates, the most frequent last, as dictionary content."""
    near = scanned.select(F.explode("found").alias("c")).select(F.concat_ws(" ", "c.before", "c.after").alias("near"))
    names = near.select(F.explode(F.regexp_extract_all("near", F.lit("[A-Za-z_][A-Za-z0-9_]{2,}"), F.lit(0))).alias("name"))
    top = names.groupBy("name").count().where("count > 1").orderBy(F.desc("count"), "name").limit(IDENTIFIERS).collect()
    return " ".join(r["name"] for r in reversed(top)).encode()[-DICTIONARY:]


def novelty(found: dict, make: zstandard.ZstdCompressor) -> int:
    """Bytes the candidate adds to its compressed surroundings."""
    before, after = found["before"].encode(), found["after"].encode()
    value = found["value"].encode()
    return len(make.compress(before + value + after)) - len(make.compress(before + after))


def report(scanned: DataFrame, dictionary: bytes) -> DataFrame:
    """Per scanned row: counts and digest of the base spans, and all spans as text."""

    def factory():
        raw = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(dictionary) >= 8 else None
        make = zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False)

        def new(c):
            added = novelty(c, make)
            return added >= LEAST_BYTES and added >= NOVELTY * len(c["value"])

        return lambda rows: {"more": [[{"start": c["start"], "kind": 3, "end": c["end"]} for c in own if new(c)] for own in rows]}

    kinds = F.array(*[F.lit(k) for k in KINDS])
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    more = map_texts(scanned, factory, "more array<struct<start:int,kind:int,end:int>>", text="found")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return more.select("doc_id", count(0), count(1), count(2), F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(F.array_sort(F.concat("base", "more"))).alias("spans"))


def find(docs: DataFrame) -> DataFrame:
    """Secrets of every whole text of ``docs`` (``doc_id``, ``text``), a row per row.

    Null and empty texts hold none; null and repeated ids are rows like any
    other; no rows give no rows; other columns are not read.
    """
    with Scratch(docs.sparkSession) as scratch:
        scanned = scratch.write(scan(docs), "scanned")
        return scratch.keep(report(scanned, identifiers(scanned)), "secrets")


def digest(spans: list[tuple[int, int, int]]) -> str:
    """``base_sha256`` of sorted (start, kind, end) spans."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()


@query("op4_secret_scan")
def op4_secret_scan(spark, sf_dir):
    return find(table(spark, sf_dir, "documents"))
