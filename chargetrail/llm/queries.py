"""All registered queries of the subpackage."""

from chargetrail.llm import (  # noqa: F401
    chunked_bpe,
    exact_dedup,
    forest,
    lexical_search,
    lm_score,
    mixing,
    near_dedup,
    passages,
    quality,
    token_alignment,
    token_files,
    toxicity,
    tree_bpe,
)
from chargetrail.llm.registry import CHECKS, QUERIES  # noqa: F401
