import hashlib
import random
import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from haulback.operators import allocate_discards, bootstrap_ratio, check_allocation, estimate_discards, ratio_rows
from haulback.operators.bootstrap import _at_level, _hashed, bucket_offsets, drawn_rows, levels_for
from haulback.session import materialize

ROWS = "analysis_group string, trip string, trip_id long, cod double, had double"


def md5(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


def by_hand(data, nrep, nsamp, seed, min_n=3):
    """Number each stratum in hash order, draw by hash, resample."""
    out = {}
    for group in sorted({r[0] for r in data if r[0] is not None}):
        strata = {}
        for flag in (0, 1):
            members = [r for r in data if r[0] == group and (r[1] != "") == bool(flag)]
            strata[flag] = [(r[3] or 1.0, r[4] or 1.0) for r in sorted(members, key=lambda r: md5(r[2]))]
        ratio = lambda rs: sum(c for c, _ in rs) / sum(h for _, h in rs)
        n = len(strata[1]), len(strata[0])
        mean = ratio(strata[1]) / ratio(strata[0]) if all(n) else None
        se = bias = None
        if min(n) >= min_n:
            reps = []
            for rep in range(1, nrep + 1):
                pick = {
                    flag: [strata[flag][int(md5(seed, group, flag, rep, d)[:15], 16) % len(strata[flag])]
                           for d in range(1, nsamp + 1)]
                    for flag in (0, 1)
                }
                reps.append(ratio(pick[1]) / ratio(pick[0]))
            se, bias = statistics.stdev(reps), statistics.fmean(reps) - mean
        out[group] = (*n, mean, se, bias)
    return out


def sample(seed=5):
    rnd = random.Random(seed)
    data = []
    for group, observed, unobserved in (("a", 20, 400), ("b", 3, 3), ("c", 2, 30), ("d", 0, 10), ("e", 10, 0), (None, 5, 5)):
        for i in range(observed + unobserved):
            trip = f"J{i}" if i < observed else ""
            data.append((group, trip, len(data), float(rnd.choice([0, 1, 5, 20])), float(rnd.choice([0, 2, 30]))))
    return data


def close(found, want):
    assert set(found) == set(want)
    for group, values in want.items():
        assert found[group] == tuple(v if v is None else pytest.approx(v) for v in values), group


def bootstrap(spark, data, **options):
    df = ratio_rows(spark.createDataFrame(data, ROWS))
    return {r[0]: tuple(r[1:]) for r in bootstrap_ratio(df, ["trip_id"], **options).collect()}


def test_bootstrap_by_hand(spark):
    data = sample()
    close(bootstrap(spark, data, nrep=50, nsamp=10, seed=86), by_hand(data, 50, 10, 86))


def test_bootstrap_does_not_depend_on_order_or_partitions(spark):
    data = sample()
    first = bootstrap(spark, data, nrep=20)
    random.Random(1).shuffle(data)
    df = ratio_rows(spark.createDataFrame(data, ROWS).repartition(7))
    again = {r[0]: tuple(r[1:]) for r in bootstrap_ratio(df, ["trip_id"], nrep=20).collect()}
    close(again, first)


def test_bootstrap_spread_is_that_of_samples_of_ten(spark):
    rnd = random.Random(7)
    data = [("a", "J" if i % 2 else "", i, rnd.uniform(5, 15), rnd.uniform(5, 15)) for i in range(600)]
    _, _, mean, se, bias = bootstrap(spark, data, nrep=1000)["a"]
    strata = [[r for r in data if (r[1] != "") == flag] for flag in (True, False)]
    ratio = lambda rs: sum(r[3] for r in rs) / sum(r[4] for r in rs)
    reps = [ratio(rnd.choices(strata[0], k=10)) / ratio(rnd.choices(strata[1], k=10)) for _ in range(4000)]
    assert se == pytest.approx(statistics.stdev(reps), rel=0.1)
    assert abs(bias - (statistics.fmean(reps) - mean)) < 0.02


@pytest.mark.parametrize("digits", [1, 3, 4])
def test_the_levels_of_buckets_change_nothing(spark, monkeypatch, digits):
    data = sample()
    want = bootstrap(spark, data, nrep=20)
    monkeypatch.setattr("haulback.operators.bootstrap.DIGITS", digits)
    close(bootstrap(spark, data, nrep=20), want)


def test_many_draws_need_no_broadcast(spark, monkeypatch):
    data = sample()
    want = bootstrap(spark, data, nrep=20)
    monkeypatch.setattr("haulback.operators.bootstrap.BROADCAST_DRAWS", 0)
    close(bootstrap(spark, data, nrep=20), want)


def trips_of_one_group(spark, n):
    return ratio_rows(spark.range(n).select(
        F.lit("a").alias("analysis_group"), F.when(F.col("id") % 2 == 0, "J").otherwise("").alias("trip"),
        F.col("id").alias("trip_id"), F.lit(1e0).alias("cod"), F.lit(1e0).alias("had")))


def test_counts_and_rows_at_every_level_follow_the_draws(spark):
    """Ten and a hundred times the rows: no level counts or windows more than 256 buckets a draw."""
    draws = 2 * 2 * 5
    for n in (10_000, 100_000, 1_000_000):
        hashed = materialize(_hashed(trips_of_one_group(spark, n), ["trip_id"]), "hashed")
        hit, placed, counted = drawn_rows(hashed, 2, 5, 86, 3)
        counts = [level.count() for level in counted]
        assert len(counts) == levels_for(n // 2) and all(c <= 256 * draws for c in counts)
        assert placed.count() == draws and hit.count() <= 1.2 * draws


def test_levels_follow_the_largest_stratum():
    assert [levels_for(n) for n in (0, 1, 16, 17, 4096, 4097, 4_000_000_000)] == [1, 1, 1, 2, 2, 3, 5]
    assert levels_for(10**60) == 16


def test_rows_with_one_digest_are_numbered_together(spark):
    data = [("a", "J" if k % 2 else "", 1, float(k), 1.0) for k in range(40)]
    out = bootstrap(spark, data, nrep=30)["a"]
    assert out[:2] == (20, 20) and out[3] > 0


def test_bucket_offsets_number_a_stratum_without_gaps(spark):
    hashed = _at_level(_hashed(trips_of_one_group(spark, 5000).where("observed = 0"), ["trip_id"]), 0)
    counts = {r.digits: r["count"] for r in hashed.groupBy("digits").count().collect()}
    assert len(counts) == 256
    upto = 0
    for r in bucket_offsets(hashed).orderBy("digits").collect():
        assert (r.start, r.prefix_rows, r.prefix) == (upto, 2500, "")
        upto += counts[r.digits]
    assert upto == 2500


def test_estimate_discards(spark):
    results = spark.createDataFrame(
        [("a", 1.5), ("b", 0.9), ("c", None), ("d", 3.0), ("e", -1.0), ("f", 2.0)], "analysis_group string, mean double")
    land = spark.createDataFrame(
        [("a", 2000.0, 500.0), ("b", 2000.0, 1.0), ("c", None, 4.0), ("d", None, 4.0), ("f", 1000.0, None)],
        "analysis_group string, unobsland_kg double, obsland_kg double")
    flags = spark.createDataFrame([("a", 1), ("f", 0)], "analysis_group string, significant int")
    out = estimate_discards(results, land, flags)
    assert rows(out, "analysis_group", "mean", "discards", "significant", "sigdiscards") == [
        ("a", 1.5, 1.0, 1, 1.0), ("b", 0.9, 0.0, 0, 0.0), ("c", None, 0.0, 0, 0.0), ("d", 3.0, 0.0, 0, 0.0),
        ("e", None, 0.0, 0, 0.0), ("f", 2.0, 1.0, 0, 0.0)]
    from_file = results.join(land, "analysis_group", "left")
    assert rows(estimate_discards(from_file, None, flags), "analysis_group", "discards") == rows(out, "analysis_group", "discards")


def test_allocation_adds_up(spark):
    grouped = spark.createDataFrame([
        ("v1", 1, "a", "", 1.0, 30.0), ("v1", 1, "a", "", 1.0, 30.0), ("v2", 2, "a", "", 5.0, 40.0),
        ("v2", 2, "a", "J1", 5.0, 400.0),  # observed
        ("v3", 3, "b", "", 5.0, 10.0),  # not significant
        ("v3", 3, "z", "", 5.0, 0.0),  # no haddock
        ("v4", 4, None, "", 5.0, 10.0),
    ], "vessel_name string, licence_id long, analysis_group string, trip string, cod double, had double")
    estimates = spark.createDataFrame(
        [("a", 5.0, 1), ("b", 7.0, 0), ("z", 2.0, 1)], "analysis_group string, discards double, significant int")
    out = allocate_discards(grouped, estimates)
    assert rows(out, "vessel", "analysis_group", "codkg", "haddockkg", "portion", "discardsmt") == [
        ("v1", "a", 2.0, 60.0, 0.6, 3.0), ("v2", "a", 5.0, 40.0, 0.4, 2.0), ("v3", "z", 5.0, 0.0, None, None)]
    assert rows(check_allocation(out, estimates)) == [("a", 5.0, 5.0), ("z", None, 2.0)]
