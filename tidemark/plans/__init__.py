"""Registered queries, each with DuckDB SQL for the same rows where SQL can express them."""

from . import portfolio_queries, relational_queries, research_queries, series_queries  # noqa: F401
from . import check_queries  # noqa: F401, I001  (after the others: it reads their checks)
from .registry import ORACLE, QUERIES  # noqa: F401
