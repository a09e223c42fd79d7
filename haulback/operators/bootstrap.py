"""Observed over unobserved cod:haddock ratio per group, with a stratified bootstrap.

A group may hold a third of all trips, so no stratum is ever numbered, sorted or collected in one
task. Drawing row number r of a stratum means finding its r-th order statistic by a hash of the
rows' content, and that is a descent through a radix histogram: the rows are counted by two hex
digits of the hash, each draw (replicates x sample size x strata, a number that does not grow with
the data) falls into one of the 256 buckets, and only buckets that were hit are counted by the next
two digits. Every level has at most 256 counts for each draw, whatever the number of rows, and
there are as many levels as the largest stratum needs for buckets of about one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.trips import observed_flag
from ..functions.weights import floor_zero, safe_ratio
from ..session import materialize

# --- fixed values -----------------------------------------------------------------------------
REPLICATES = 1000
SAMPLE_SIZE = 10
SEED = 86
MIN_ROWS = 3
# ----------------------------------------------------------------------------------------------

STRATUM = ["analysis_group", "observed"]
#: Hex digits of the hash by which rows are told apart at each level.
DIGITS = 2
#: Buckets of the last level for each row of the largest stratum, at least.
BUCKETS_PER_ROW = 16
#: Draws made or placed by one task, about; they are few but costly, whatever their size in bytes.
TASK_DRAWS = 8192
#: Hit buckets are broadcast up to so many draws: some 60 bytes each.
BROADCAST_DRAWS = 1_000_000


def ratio_rows(grouped: DataFrame) -> DataFrame:
    """Rows entering the ratio: floored weights, observed flag; rows without a group left out."""
    return (
        grouped.where(F.col("analysis_group").isNotNull())
        .withColumn("observed", observed_flag(F.col("trip")))
        .withColumn("cod", floor_zero(F.col("cod")))
        .withColumn("had", floor_zero(F.col("had")))
    )


def ratio_of_ratios(rows: DataFrame) -> DataFrame:
    """Point estimate per group, with the stratum sizes; null if a stratum is absent."""
    part = lambda flag, c: F.sum(F.when(F.col("observed") == flag, F.col(c)))
    sums = rows.groupBy("analysis_group").agg(
        F.count_if(F.col("observed") == 1).alias("n_obs"), F.count_if(F.col("observed") == 0).alias("n_unobs"),
        part(1, "cod").alias("cod_obs"), part(1, "had").alias("had_obs"),
        part(0, "cod").alias("cod_unobs"), part(0, "had").alias("had_unobs"),
    )
    mean = safe_ratio(
        safe_ratio(F.col("cod_obs"), F.col("had_obs")), safe_ratio(F.col("cod_unobs"), F.col("had_unobs"))
    )
    return sums.select("analysis_group", "n_obs", "n_unobs", mean.alias("mean"))


def _hash_number(*parts: Column) -> Column:
    """60 bits of an MD5 over the parts: well mixed, and the same on every engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("bigint")


def _hashed(rows: DataFrame, key: list[str]) -> DataFrame:
    """The narrow rows that are drawn from, in the order of ``digest``."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]))
    return rows.select(*STRATUM, "cod", "had", digest.alias("digest"))


def _at_level(hashed: DataFrame, level: int) -> DataFrame:
    """With ``prefix``, the digits of the levels above, and ``digits``, those of this one."""
    return hashed.withColumns({
        "prefix": F.substring("digest", 1, DIGITS * level), "digits": F.substring("digest", 1 + DIGITS * level, DIGITS),
    })


def bucket_offsets(rows: DataFrame) -> DataFrame:
    """First row number of each bucket (``digits``) among the rows of its ``prefix``, and how many those are."""
    within = [*STRATUM, "prefix"]
    counts = rows.groupBy(*within, "digits").agg(F.count(F.lit(1)).alias("n"))
    all_ = Window.partitionBy(*within)
    before = all_.orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *within, "digits",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        F.sum("n").over(all_).alias("prefix_rows"),
    )


def _tasks(draws: int) -> int:
    return max(1, -(-draws // TASK_DRAWS))


def draws(strata: DataFrame, nrep: int, nsamp: int, seed: int, tasks: int) -> DataFrame:
    """``nsamp`` row numbers per replicate and stratum, with replacement."""
    return (
        strata.withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(nrep))))
        .repartition(tasks, *STRATUM, "rep")
        .withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(nsamp))))
        .withColumn("row", F.pmod(
            _hash_number(F.lit(seed), F.col("analysis_group"), F.col("observed"), F.col("rep"), F.col("draw")),
            F.col("prefix_rows"),
        ))
        .select(*STRATUM, F.lit("").alias("prefix"), "rep", "row")
    )


def place_draws(drawn: DataFrame, offsets: DataFrame, tasks: int) -> DataFrame:
    """The draws one level down: ``prefix`` longer by the digits of the bucket hit, ``row`` the number within it.

    Draws and bucket starts are merged in one ordered window, whose size is bounded by the number
    of buckets plus draws.
    """
    within = [*STRATUM, "prefix"]
    starts = offsets.select(
        *within, F.col("start").alias("row"), F.lit(None).cast("int").alias("rep"), F.struct("digits", "start").alias("at"))
    no_start = F.lit(None).cast(starts.schema["at"].dataType).alias("at")
    both = drawn.select(*within, "row", "rep", no_start).unionByName(starts).repartition(tasks, *within)
    # nulls first: a bucket that starts at the drawn row precedes the draw
    upto = Window.partitionBy(*within).orderBy("row", F.col("rep").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        both.withColumn("at", F.last("at", ignorenulls=True).over(upto))
        .where(F.col("rep").isNotNull())
        .select(*STRATUM, F.concat("prefix", "at.digits").alias("prefix"), "rep", (F.col("row") - F.col("at.start")).alias("row"))
    )


def _in_hit_buckets(rows: DataFrame, placed: DataFrame, drawn: int) -> DataFrame:
    """The rows whose prefix was hit. The prefixes are sent to the rows as long as the number of draws bounds them."""
    hit = placed.select(*STRATUM, "prefix").distinct()
    return rows.join(F.broadcast(hit) if drawn <= BROADCAST_DRAWS else hit, [*STRATUM, "prefix"], "left_semi")


def levels_for(rows: int) -> int:
    """Levels after which a stratum of ``rows`` rows has ``BUCKETS_PER_ROW`` buckets a row, as far as the digest reaches."""
    level = 1
    while 16 ** (DIGITS * level) < BUCKETS_PER_ROW * rows and DIGITS * (level + 1) <= 32:
        level += 1
    return level


def drawn_rows(hashed: DataFrame, nrep: int, nsamp: int, seed: int, min_n: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """``(rows, placed, counted)``: the rows of all buckets that were hit at the last level, the draws' places in them,
    and the bucket counts of each level."""
    offsets = materialize(bucket_offsets(_at_level(hashed, 0)), "buckets")
    strata = offsets.groupBy(*STRATUM).agg(F.max("prefix_rows").alias("prefix_rows")).where(F.col("prefix_rows") >= min_n)
    number, largest = strata.agg(F.count(F.lit(1)), F.max("prefix_rows")).first()
    drawn = number * nrep * nsamp
    tasks = _tasks(drawn)
    placed, counted = draws(strata, nrep, nsamp, seed, tasks), []
    for level in range(levels_for(largest or 0)):
        if level:
            offsets = bucket_offsets(_in_hit_buckets(_at_level(hashed, level), placed, drawn))
        counted.append(offsets)
        # Written out: read twice, and small (draws x strata).
        placed = materialize(place_draws(placed, offsets, tasks), "draws")
    return _in_hit_buckets(_at_level(hashed, len(counted)), placed, drawn), placed, counted


def bootstrap_ratio(rows: DataFrame, key: list[str], nrep: int = REPLICATES, nsamp: int = SAMPLE_SIZE,
                    seed: int = SEED, min_n: int = MIN_ROWS) -> DataFrame:
    """``(analysis_group, n_obs, n_unobs, mean, se, bias)``.

    ``rows`` comes from :func:`ratio_rows`; ``key`` names columns that tell its rows apart and fix
    their numbering. Each replicate draws ``nsamp`` rows per stratum with replacement. Groups with
    fewer than ``min_n`` rows in a stratum get no standard error and bias. Draws are keyed by
    (seed, group, stratum, replicate, draw), so results do not depend on partitioning.
    """
    point = ratio_of_ratios(rows)
    # Written once: the digest is the costly part, and every level reads it.
    hashed = materialize(_hashed(rows, key), "hashed")
    hit, placed, _ = drawn_rows(hashed, nrep, nsamp, seed, min_n)
    in_bucket = Window.partitionBy(*STRATUM, "prefix").orderBy("digest", "cod", "had")
    numbered = hit.select(*STRATUM, "prefix", "cod", "had", (F.row_number().over(in_bucket) - 1).cast("bigint").alias("row"))
    is_obs = F.col("observed") == 1
    replicates = (
        numbered.join(placed, [*STRATUM, "prefix", "row"])
        .groupBy("analysis_group", "rep")
        .agg(
            F.sum(F.when(is_obs, F.col("cod"))).alias("co"), F.sum(F.when(is_obs, F.col("had"))).alias("ho"),
            F.sum(F.when(~is_obs, F.col("cod"))).alias("cu"), F.sum(F.when(~is_obs, F.col("had"))).alias("hu"),
        )
        .select("analysis_group", safe_ratio(
            safe_ratio(F.col("co"), F.col("ho")), safe_ratio(F.col("cu"), F.col("hu"))).alias("ratio"))
        .groupBy("analysis_group")
        .agg(F.stddev_samp("ratio").alias("se"), F.avg("ratio").alias("rep_mean"))
    )
    return point.join(replicates, "analysis_group", "left").select(
        "analysis_group", "n_obs", "n_unobs", "mean", "se", (F.col("rep_mean") - F.col("mean")).alias("bias")
    )
