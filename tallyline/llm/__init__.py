"""Operators of a training-data pipeline; nothing else in the package imports this folder."""

from tallyline.llm import (  # noqa: F401
    decontaminate,
    language,
    minhash,
    mixing,
    pii,
    prefix_trie,
    quality,
    secrets,
    simhash,
    spelling,
    substring_dedup,
    token_counts,
    toxicity,
)
from tallyline.llm.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
