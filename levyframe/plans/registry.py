"""All queries of the library proper."""

from __future__ import annotations

from levyframe.plans import audits, inputs, joins, pages, rating, shapes  # noqa: F401
from levyframe.plans.fixtures import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
