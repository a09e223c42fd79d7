"""Sums that a run must keep, measured while its tables are written."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import materialize

#: Sums of doubles differ by their order; more than this share is a loss.
TOLERANCE = 1e-9


class RunCheckError(RuntimeError):
    """A step lost or made up rows or weights."""


class Measured:
    """Counts and sums of a run's tables, taken by the jobs that write them: nothing is read once more."""

    def __init__(self):
        self.values: dict[str, dict[str, float]] = {}
        self._open: dict[str, Observation] = {}

    def watch(self, df: DataFrame, label: str, **sums: Column) -> DataFrame:
        """``df``, to be counted, and summed up by name, by the next job that runs through it once."""
        seen = self._open[label] = Observation(f"{label}-{uuid.uuid4().hex}")
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in sums.items()])

    def written(self, df: DataFrame, label: str, keep_layout: bool = False, **sums: Column) -> DataFrame:
        """``df`` as a written table, see :func:`..session.materialize`; what it watches is known afterwards."""
        table = materialize(self.watch(df, label, **sums), label, keep_layout, "zstd")
        self.values |= {name: dict(seen.get) for name, seen in self._open.items()}
        self._open.clear()
        return table

    def counts(self) -> list[tuple[str, str, float | None]]:
        """``(table, measure, value)`` for a report."""
        return [(table, name, None if value is None else float(value)) for table, sums in self.values.items() for name, value in sums.items()]

    def rows(self, label: str) -> int:
        return self.values[label]["rows"]

    def same(self, what: str, found, expected) -> None:
        if not math.isclose(found or 0, expected or 0, rel_tol=TOLERANCE, abs_tol=TOLERANCE):
            raise RunCheckError(f"{what}: {found} where {expected} are due")

    def at_least(self, what: str, found, expected) -> None:
        if found < expected:
            raise RunCheckError(f"{what}: {found} where {expected} are due")


def weights() -> dict[str, Column]:
    return {c: F.sum(c) for c in ("cod", "had", "pol")}


def count_by(column: str, values: list[str]) -> dict[str, Column]:
    """The rows of each of ``values``, by name."""
    return {value: F.count_if(F.col(column) == value) for value in values}
