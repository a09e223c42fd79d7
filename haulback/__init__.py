"""Discard estimation from landings and at-sea observer records, on Spark DataFrames."""

from . import functions, operators, sources
from .plans.pipeline import DiscardRun, run_discards
from .session import build_session, materialize, shared_folder

__all__ = ["functions", "operators", "sources", "DiscardRun", "run_discards", "build_session", "materialize", "shared_folder"]
