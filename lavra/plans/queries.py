"""All registered queries."""

from lavra.plans import checks, cleaning, joining, modelling, rankings, reading, summaries  # noqa: F401
from lavra.plans.registry import QUERIES, Tables

__all__ = ["QUERIES", "Tables"]
