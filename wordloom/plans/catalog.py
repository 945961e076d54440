"""All registered queries."""

from wordloom.plans import (  # noqa: F401
    page_queries, source_queries, subword_queries, text_queries, token_queries,
)
from wordloom.plans.registry import ORACLES, QUERIES  # noqa: F401
