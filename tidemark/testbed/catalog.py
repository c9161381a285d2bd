"""All registered queries."""

from tidemark.testbed import q_generic, q_models, q_quality, q_sources, q_stream  # noqa: F401
from tidemark.testbed.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
