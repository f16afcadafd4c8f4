"""All registered queries."""

from mapflow.queries import (  # noqa: F401 - registration
    checks,
    flows,
    grouping,
    intake,
    joining,
    ranking,
    reconcile,
    scalars,
    scans,
    sets,
    shaping,
)
from mapflow.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
