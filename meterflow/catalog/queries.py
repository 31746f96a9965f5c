"""All registered queries."""
from . import country, ordered, scans, shapes  # noqa: F401  (registration)
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
