"""All queries over the reference operators, and their oracles."""

from . import choice_queries, extract_queries, flow_queries, generation_queries, masked_queries, option_queries, stream_queries, text_queries, vector_queries  # noqa: F401  they register themselves
from .base import ORACLES, QUERIES
from .text_queries import flagship

__all__ = ["ORACLES", "QUERIES", "flagship"]
