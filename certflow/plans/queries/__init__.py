"""Driver queries over the given tables, each with its SQL twin where SQL can say it."""

from certflow.plans.queries.registry import QUERIES, SQL
from certflow.plans.queries import imports, joins, landing, lifecycle, parts, reports, texts, stages, stored  # noqa: F401

__all__ = ["QUERIES", "SQL"]
