"""Language by compression (operator 6).

Each language has a raw-content zstandard dictionary cut from a bounded sample
of its training texts.  A text is compressed in short blocks with every
dictionary - blocks, so that a long text is measured against the dictionary
and not against itself - and the smallest total names the language.  A narrow
margin is marked as rejected.
"""

from __future__ import annotations

import math
import re

import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.base import held_out, map_texts, needed, query, table
from tallyline.shipping import by_value

by_value(__name__)

#: Training texts sampled per language, characters taken of each, and bytes of a dictionary.
TEXTS, PIECE, DICTIONARY = 160, 1000, 64 << 10
#: Languages at most, by number of training texts.
LANGUAGES = 128
BLOCK, LEVEL = 4096, 6
#: Rejected below this share of the runner-up's bytes.
MARGIN = 0.01
#: Bytes of difference that make one language e times likelier than another.
SCALE = 8.0

_LETTER = regex.compile(r"\p{L}")
_NOT_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def plain(text: str) -> bytes:
    """Lower case, ASCII other than letters as blanks."""
    return re.sub(rb" +", b" ", text.lower().encode("utf-8", "surrogatepass").translate(_NOT_LETTERS))


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False)


def learn(docs: DataFrame) -> dict[str, bytes]:
    """Dictionary of each ``lang``, the most frequent first, from rows outside the held-out fold with a text and a language."""
    rows = needed(docs, "doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return {}
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], min(1.0, TEXTS / r["count"]))])[F.col("lang")]
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) / 1_000_000
    start = 1 + F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - PIECE, F.lit(1)))
    taken = rows.where(chance < share).select("lang", F.xxhash64("doc_id", "text").alias("order"), F.substring(F.col("text"), start, F.lit(PIECE)).alias("piece"))
    pieces: dict[str, list[bytes]] = {}
    for row in taken.orderBy("lang", "order", "piece").collect():
        pieces.setdefault(row["lang"], []).append(plain(row["piece"]))
    common = [r["lang"] for r in counts if r["lang"] in pieces]
    return {lang: content for lang in common if (content := b" ".join(pieces[lang])[:DICTIONARY]).strip()}


def classify(text: str | None, compressors: dict[str, zstandard.ZstdCompressor]) -> tuple[str, float, bool]:
    """(language, score, rejected); ties go to the language listed first."""
    if not text or not compressors or not _LETTER.search(text):
        return "und", 0.0, True
    raw = plain(text)
    parts = [raw[k : k + BLOCK] for k in range(0, len(raw), BLOCK)]
    sizes = {lang: sum(len(c.compress(p)) for p in parts) for lang, c in compressors.items()}
    first = min(sizes, key=sizes.__getitem__)
    rest = sorted(size for lang, size in sizes.items() if lang != first)
    likely = 1 / (1 + sum(math.exp(-min(700.0, (size - sizes[first]) / SCALE)) for size in rest))
    return first, likely, bool(rest) and (rest[0] - sizes[first]) < MARGIN * rest[0]


def predict(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """Per row ``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``rejected`` (narrow margin).

    ``und`` with score 0 if the text is null or has no letter, or nothing was
    learned.  Only the text is read; null and repeated ids are rows like any
    other; no rows give no rows.
    """

    def factory():
        made = {lang: compressor(content) for lang, content in dictionaries.items()}

        def run(texts):
            found = [classify(t, made) for t in texts]
            return {name: [f[k] for f in found] for k, name in enumerate(("lang_pred", "score", "rejected"))}

        return run

    rows = needed(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return map_texts(rows, factory, "lang_pred string, score double, rejected boolean")


@query("op6_language_id")
def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return predict(docs, learn(docs))
