"""Party and candidate text: standard names from what is printed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.functions.nulls import col, first_match
from tallyline.functions.text import decompose, detect, remove_all, squish
from tallyline.rules import vocabulary as V


def standard_party(c: Column | str) -> Column:
    """Free-text party of a vendor's party list -> standard name, else upper case."""
    return first_match([(detect(c, p), name) for name, p in V.PARTY_LIST_MARKS], F.upper(col(c)))


def party_from_marks(
    party: Column | str, candidate: Column | str, marks: Sequence[tuple[str, str]] = V.PARTY_MARKS
) -> Column:
    """A stated party wins; else the first mark found in the candidate text."""
    return F.coalesce(F.upper(col(party)), first_match([(detect(candidate, p), name) for name, p in marks]))


def without_noise(c: Column | str, noise: str = V.TEXT_NOISE) -> Column:
    """Drop missing-value spellings, a closing bracket part, punctuation; upper case."""
    return F.upper(decompose(remove_all(c, noise)))


def president_name(office: Column | str, candidate: Column | str, otherwise: Column) -> Column:
    """One spelling per presidential candidate; other offices take ``otherwise``."""
    running = col(office) == "US PRESIDENT"
    return first_match([(running & detect(candidate, p), name) for p, name, _ in V.PRESIDENT], otherwise)


def president_party(office: Column | str, candidate: Column | str, otherwise: Column) -> Column:
    running = col(office) == "US PRESIDENT"
    known = [(running & (col(candidate) == name), party) for _, name, party in V.PRESIDENT if party]
    return first_match(known, otherwise)


def unify_writein(c: Column | str) -> Column:
    """Any text that says write-in becomes the one label."""
    return F.when(col(c).rlike("WRITE"), F.lit("WRITEIN")).otherwise(col(c))


def final_text(c: Column | str, noise: str = V.TEXT_NOISE) -> Column:
    return squish(remove_all(c, noise))
