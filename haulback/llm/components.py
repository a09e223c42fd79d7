"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulback.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long, not null): ``root`` is the smallest node it can reach.

    Each round hangs larger neighbours, then all smaller ones, on the smallest neighbour, until nothing changes; the
    number of edges never grows and rounds are logarithmic in the size of a component. Every round is written to the
    shared folder, so the plan stays short and a lost executor costs its tasks only. A node with many neighbours has
    one minimum, combined before the shuffle; its edges meet that in an ordinary join, which AQE can split. Loops and
    repeated edges don't matter; no edges give no rows.
    """
    current = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _state(current)
    while before[0]:
        current = materialize(_small_star(_large_star(current)), "edges")
        after = _state(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    met = edges.join(least, "a")
    moved = met.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
