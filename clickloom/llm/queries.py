"""All registered queries of the subpackage."""

from __future__ import annotations

import corpus_pipeline  # noqa: F401
from clickloom.llm import (  # noqa: F401
    alignment,
    block_naming,
    bpe,
    decontamination,
    jaccard,
    langid,
    licenses,
    line_dedup,
    masked_lm,
    mixing,
    sharding,
    spelling,
    vafile,
)
from clickloom.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
