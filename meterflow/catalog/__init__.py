"""Every operator as a query over the given tables, with the SQL it must agree with."""
from .queries import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
