"""Governed, month-based data pipelines as plain Spark DataFrames."""

from mapflow.plans.mapping import run_mapping
from mapflow.session import build_session

__all__ = ["build_session", "run_mapping"]
