"""Queries over the test tables, one per operator, with the SQL they are checked against."""

from . import aggregates, expressions, jobs, monitors, reports, shaping, stored  # noqa: F401
from .registry import QUERIES  # noqa: F401
