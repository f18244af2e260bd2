"""All queries of the subpackage, by name, and their SQL where it can express them."""

from wordloom.llm import (  # noqa: F401  each module registers its query
    alignment, bpe, compression, importance, language, near_dup, packing, permutation_index, quality, secrets, substrings, token_store, toxicity,
)
from wordloom.llm.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
