"""Discards per group and their allocation to vessels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.weights import KG_PER_TONNE, safe_ratio


def estimate_discards(results: DataFrame, landings: DataFrame | None, flags: DataFrame) -> DataFrame:
    """Discards per group in tonnes: the landings that the ratio says are missing.

    ``results`` has ``analysis_group`` and ``mean`` (from the bootstrap, or read from a file that already
    holds the landings, with ``landings=None``); ``landings`` is the observed/unobserved pivot;
    ``flags`` says which groups are significant, 0 where it names none. A ratio that is null or not
    above 1 gives 0.
    """
    joined = results if landings is None else results.join(landings, "analysis_group", "left")
    mean = F.when(F.col("mean") > 0, F.col("mean"))
    unobs = F.col("unobsland_kg") / KG_PER_TONNE
    discards = F.coalesce(F.greatest(F.when(mean > 1, mean * unobs - unobs), F.lit(0e0)), F.lit(0e0))
    keep = [c for c in ("n_obs", "n_unobs", "se", "bias") if c in joined.columns]
    return (
        joined.select("analysis_group", *keep, mean.alias("mean"), (F.col("obsland_kg") / KG_PER_TONNE).alias("obsland"),
                      unobs.alias("unobsland"), discards.alias("discards"))
        .join(flags.select("analysis_group", "significant"), "analysis_group", "left")
        .withColumn("significant", F.coalesce("significant", F.lit(0)))
        .withColumn("sigdiscards", F.col("discards") * F.col("significant"))
    )


def allocate_discards(grouped: DataFrame, estimates: DataFrame) -> DataFrame:
    """Significant discards shared out to vessels by their part of the group's unobserved haddock.

    The group totals are aggregated and joined back rather than taken over a window, which would
    bring all vessels of a group to one task. A group without haddock gets null shares.
    """
    # Both broadcasts hold at most one row per group rule.
    significant = F.broadcast(estimates.where(F.col("significant") == 1).select("analysis_group", "discards"))
    unobserved = grouped.where(F.col("trip") == "").join(significant, "analysis_group")
    vessels = unobserved.groupBy("vessel_name", "licence_id", "analysis_group", "discards").agg(
        F.sum("cod").alias("codkg"), F.sum("had").alias("haddockkg")
    )
    totals = F.broadcast(unobserved.groupBy("analysis_group").agg(F.sum("had").alias("group_had")))
    return (
        vessels.join(totals, "analysis_group")
        .withColumn("portion", safe_ratio(F.col("haddockkg"), F.col("group_had")))
        .select(F.col("vessel_name").alias("vessel"), "licence_id", "analysis_group", "codkg", "haddockkg", "portion",
                (F.col("portion") * F.col("discards")).alias("discardsmt"))
    )


def check_allocation(allocated: DataFrame, estimates: DataFrame) -> DataFrame:
    """Allocated discards per group beside the group's own, which they must add up to."""
    sums = allocated.groupBy("analysis_group").agg(F.sum("discardsmt").alias("allocated"))
    return sums.join(estimates.select("analysis_group", "discards"), "analysis_group")
