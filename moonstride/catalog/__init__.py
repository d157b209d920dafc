"""Every operator as a query over the test tables, each with the SQL it must agree with."""

from moonstride.catalog import (  # noqa: F401  (importing registers the queries)
    aggregates,
    checks,
    files,
    filters,
    joins,
    models,
    questions,
    rows,
    sequences,
    times,
)
from moonstride.catalog.registry import oracles, registered

__all__ = ["oracles", "registered"]
