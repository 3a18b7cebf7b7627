"""Operators that prepare training text at scale, with their registered queries."""

from holdfast.llm import (  # noqa: F401
    decontaminate,
    langid,
    lattice,
    mixing,
    negatives,
    quality,
    resampling,
    secrets,
    simhash,
    substrings,
    tokens,
    toxicity,
    warc,
)
from holdfast.llm.entries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
