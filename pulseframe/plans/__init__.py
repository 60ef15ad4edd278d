"""Registered queries over the given tables, each with equivalent SQL where SQL can say it."""

from pulseframe.plans import (  # noqa: F401
    alerting,
    cases,
    ingest,
    kept,
    people,
    replay,
    series,
    states,
    streams,
    upkeep,
    vitals,
)
from pulseframe.plans.registry import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
