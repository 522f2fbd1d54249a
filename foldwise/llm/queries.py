"""Every query of this subpackage, by name."""

from foldwise.llm import (  # noqa: F401
    fingerprints_query,
    language_query,
    lines_query,
    mixing_query,
    neighbours_query,
    packing_query,
    quality_query,
    ranked_query,
    repair_query,
    repeats_query,
    similar_query,
    simhash_query,
    urls_query,
)
from foldwise.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
