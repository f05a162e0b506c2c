"""All registered queries."""

from tidemark.suite import drift, learning, log, models, streams  # noqa: F401
from tidemark.suite.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
