"""All queries of this subpackage, by name."""

from rowmill.llm import (  # noqa: F401
    decontaminate_queries,
    extraction_queries,
    fingerprint_queries,
    interpolation_queries,
    mixing_queries,
    near_queries,
    repeat_queries,
    square_queries,
    token_queries,
    toxicity_queries,
    trie_queries,
    warc_queries,
)
from rowmill.llm.tables import ORACLES, QUERIES  # noqa: F401
