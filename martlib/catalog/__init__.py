"""All registered queries, by area."""

from martlib.catalog import (  # noqa: F401 - importing registers the queries
    storage, relational, joining, aggregating, windowing, scalar, checking, flagship, product, companies, journeys,
)
from martlib.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
