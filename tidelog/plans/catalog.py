"""All catalog queries."""

from tidelog.plans import catalog_groups, catalog_rows, catalog_sources  # noqa: F401
from tidelog.plans.registry import QUERIES, TWINS

__all__ = ["QUERIES", "TWINS"]
