"""Small document tables with the awkward rows every operator must take."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "ba ke lo mi nu ra se ti vo xu da fe gi ho ju".split()


def words(n, seed, syllables=SYLLABLES):
    rng = random.Random(seed)
    return ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def prose(n, seed, syllables=SYLLABLES):
    return " ".join(words(n, seed, syllables))


def table(spark, rows):
    """``rows`` of (doc_id, text, lang, source) with other columns whose names operators use inside."""
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)
    extra = "size score fp chunk spans key hash row held label copies target mark lam text_key copy fp_of_text row_of_text".split()
    return df.withColumns({c: F.lit("x") for c in extra})


def edges():
    """Null and empty texts, null and repeated ids and rows, one word, no letters, odd spaces, a very long text."""
    same = prose(80, 1)
    return [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n\x0b\x0c\r ", "en", "a"), (4, "one", "en", "b"), (None, same, "en", "b"),
        (None, same, None, "b"), (6, same, "fr", None), (6, same, "fr", None), (7, same + " tail", "fr", "a"), (8, "12345 !!! ???", "de", "c"),
        (9, prose(60_000, 2), "de", "c"), (10, "x" * 300_000, "de", "c"), (2**60 + 1, "é  \U0001f600 a\x1fb " + prose(50, 3), "en", "a"),
    ]


def empty(spark):
    return table(spark, []).limit(0)
