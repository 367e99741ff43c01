"""Registered queries: each runs an operator on the given tables, most with equal SQL."""

from citeweave.catalog import (  # noqa: F401
    citations,
    describing,
    enriched,
    landing,
    records,
    snapshots,
    stages,
    texts,
    yearly,
)
from citeweave.catalog.registry import REGISTRY  # noqa: F401
