"""Registered queries: one per operator, each with its DuckDB counterpart where SQL can say it."""

from leadmill.catalog import aggregates, cleansing, linking, marketing, tables  # noqa: F401
from leadmill.catalog.registry import QUERIES, oracles, runners  # noqa: F401
