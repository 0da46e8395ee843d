"""Registered queries and, where SQL can state them, their oracles."""

from textloom.queries import features, models, prepare, profile, segment, text  # noqa: F401
from textloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
