"""Checked queries: each operator over whole tables, with its SQL equivalent."""

from skygauge.suite.expected import EXPECTED_SQL
from skygauge.suite.registry import QUERIES

__all__ = ["EXPECTED_SQL", "QUERIES"]
