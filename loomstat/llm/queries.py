"""All queries of this folder; importing the modules fills the registry."""

from loomstat.llm import queries_bpe, queries_models, queries_native, queries_simhash, queries_suffix, queries_trie, queries_urls, queries_whitening  # noqa: F401
from loomstat.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
