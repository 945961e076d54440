"""All queries of this package."""

from wordloom.llm import queries_corpus, queries_native, queries_text  # noqa: F401
from wordloom.llm.registry import ORACLES, QUERIES  # noqa: F401
