"""Operators of a training-data pipeline, with their registered queries and SQL."""

from layerforge.llm import bpe, centroid_clustering, embedding_dedup, exact_dedup, language_id, ngram_join, packing, prefix_trie, quality_rules, secret_scan, sharding, substring_dedup, token_counts  # noqa: F401
from layerforge.llm.common import QUERIES, SQL  # noqa: F401
