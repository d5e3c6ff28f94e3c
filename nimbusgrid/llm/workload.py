"""All queries of this folder, for the driver's entry module."""

from nimbusgrid.llm import (  # noqa: F401
    decontaminate, jaccard, language, lines, manifest, mixing, neighbours, pii, repeats, secrets, tokens, toxicity, trie)
from nimbusgrid.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
