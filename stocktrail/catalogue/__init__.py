"""Every operator as a query over the order and event tables, with the SQL it must agree with."""

from stocktrail.catalogue import basics, joins, lineage, mart, streams  # noqa: F401
from stocktrail.catalogue.registry import QUERIES

__all__ = ["QUERIES"]
