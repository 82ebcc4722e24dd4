"""The queries of the driver contract: every operator on the given tables, with its SQL."""

from catalog import (
    aggregates,
    columns,
    days,
    edges,
    joins,
    ordered,
    pages,
    products,
    scalars,
    skewed,
    sources,
)
from catalog.registry import ORACLE, QUERIES

__all__ = [
    "ORACLE",
    "QUERIES",
    "aggregates",
    "columns",
    "days",
    "edges",
    "joins",
    "ordered",
    "pages",
    "products",
    "scalars",
    "skewed",
    "sources",
]
