"""The registered queries of the text operators and their SQL counterparts."""

from __future__ import annotations

import corpus_pipeline
from foldboard.llm import (
    decontamination,
    hard_negatives,
    html_text,
    lattice_lm,
    lexical_search,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    toxicity,
)

MODULES = (
    near_dedup,
    html_text,
    toxicity,
    mixing,
    quality_classifier,
    line_dedup,
    sharding,
    lattice_lm,
    quality_rules,
    decontamination,
    lexical_search,
    packing,
    hard_negatives,
)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
