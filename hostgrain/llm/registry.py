"""The queries of this subpackage and the SQL that their results are held against."""

from __future__ import annotations

from hostgrain.llm import (
    anchor_pii,
    ball_search,
    bin_slack,
    chat_format,
    crf_language,
    exact_dedup,
    merkle_manifest,
    nn_descent,
    parity_join,
    secret_novelty,
    source_mix,
    toxic_chain,
    warc_segments,
)

_MODULES = (
    warc_segments,
    secret_novelty,
    anchor_pii,
    nn_descent,
    parity_join,
    bin_slack,
    exact_dedup,
    crf_language,
    toxic_chain,
    source_mix,
    merkle_manifest,
    chat_format,
    ball_search,
)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
