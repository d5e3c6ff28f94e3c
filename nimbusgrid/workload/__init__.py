"""Queries over the given tables, one per operator or plan, with their SQL checks."""

from nimbusgrid.workload import (  # noqa: F401
    audits,
    formulas,
    landings,
    maintained,
    models,
    panels,
    serving,
    timeseries,
)
from nimbusgrid.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
