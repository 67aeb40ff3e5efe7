"""All registered queries by name."""

from millrace.catalog import dedups, feeds, merges, projection, reports, runs, scalars, scans, streams
from millrace.catalog.base import QUERIES, SQL

__all__ = [
    "QUERIES",
    "SQL",
    "dedups",
    "feeds",
    "merges",
    "projection",
    "reports",
    "runs",
    "scalars",
    "scans",
    "streams",
]
