"""Scalar helpers: clocks, DATEADD/DATEDIFF semantics, business CASEs."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from keepwise.functions import dates, exprs


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_month_shift_keeps_time_and_clamps(spark):
    t = dates.as_of_literal(dt.datetime(2026, 5, 31, 12, 30))
    assert one(spark, dates.shift(t, "MONTH", -1)) == dt.datetime(2026, 4, 30, 12, 30)


def test_nested_shift_differs_from_summed(spark):
    as_of = dt.datetime(2026, 5, 31)
    assert one(spark, dates.nested_months_before(as_of, 1, 3)) == dt.datetime(2026, 1, 30)
    assert one(spark, dates.months_before(as_of, 4)) == dt.datetime(2026, 1, 31)


def test_hour_diff_counts_boundaries(spark):
    a = dates.as_of_literal("2026-05-31 10:59:00")
    b = dates.as_of_literal("2026-05-31 11:01:00")
    assert one(spark, dates.hour_diff(a, b)) == 1
    c = dates.as_of_literal("2026-06-01 00:00:00")
    assert one(spark, dates.hour_diff(dates.as_of_literal("2026-05-31 23:59:59"), c)) == 1
    assert one(spark, dates.hour_diff(b, a)) == -1


def test_day_diff_counts_boundaries(spark):
    a = dates.as_of_literal("2026-05-31 23:59:00")
    b = dates.as_of_literal("2026-06-01 00:01:00")
    assert one(spark, dates.day_diff(a, b)) == 1


def test_run_stamp(spark):
    assert one(spark, dates.run_stamp(dates.as_of_literal("2024-02-15 10:00:00"))) == "20240215"


def test_as_of_is_ntz(spark):
    df = spark.range(1).select(dates.as_of_literal(dt.date(2024, 2, 15)).alias("t"))
    assert df.schema["t"].dataType.simpleString() == "timestamp_ntz"


def test_safe_ratio_and_guards(spark):
    assert one(spark, exprs.safe_ratio(F.lit(3), F.lit(0))) == 0.0
    assert one(spark, exprs.safe_ratio(F.lit(3), F.lit(None).cast("int"))) == 0.0
    assert one(spark, exprs.safe_ratio(F.lit(3), F.lit(4))) == 0.75


def test_relative_change_null_and_zero(spark):
    # recent missing -> NULL (previous positive); previous zero or missing -> 0
    assert one(spark, exprs.relative_change(F.lit(None).cast("double"), F.lit(2.0))) is None
    assert one(spark, exprs.relative_change(F.lit(1.0), F.lit(0.0))) == 0.0
    assert one(spark, exprs.relative_change(F.lit(1.0), F.lit(None).cast("double"))) == 0.0
    assert one(spark, exprs.relative_change(F.lit(3.0), F.lit(2.0))) == 0.5


def test_tier_on_unrounded_probability(spark):
    p = F.lit(0.69995)
    assert one(spark, exprs.risk_tier(p)) == "Medium Risk"
    assert one(spark, p.cast("decimal(5,4)")) == Decimal("0.7000")
    assert one(spark, exprs.risk_tier(F.lit(0.7))) == "High Risk"
    assert one(spark, exprs.risk_tier(F.lit(0.39999))) == "Low Risk"


def test_lifecycle_stage(spark):
    assert [one(spark, exprs.lifecycle_stage(F.lit(d))) for d in (0, 89, 90, 364, 365)] == [
        "New", "New", "Growing", "Growing", "Established"]


def test_flag_null_is_zero(spark):
    assert one(spark, exprs.flag(F.lit(None).cast("boolean"))) == 0


def test_fill_numeric_nulls_keeps_dates_and_strings(spark):
    df = spark.createDataFrame([(1, None, None, None)], "id long, n double, d timestamp_ntz, s string")
    r = exprs.fill_numeric_nulls(df).first()
    assert r["n"] == 0.0 and r["d"] is None and r["s"] is None


def test_select_excluding(spark):
    df = spark.createDataFrame([(1, 2, 3)], "customer_id long, churned int, x int")
    assert exprs.select_excluding(df).columns == ["x"]


def test_mean_when_counts_only_matching_rows(spark):
    df = spark.createDataFrame([(1, 10.0), (0, 0.0), (1, 20.0)], "c int, v double")
    assert df.agg(exprs.mean_when(F.col("c") == 1, F.col("v"))).first()[0] == 15.0
    assert df.agg(exprs.mean_when(F.col("c") == 2, F.col("v"))).first()[0] is None


def test_size_shuffle_partitions(spark):
    from keepwise.session import input_bytes, size_shuffle_partitions

    paths = ["/root/testdata/sf0.001/orders.parquet", "/root/testdata/sf0.001/events.parquet"]
    assert input_bytes(spark, paths) > 0
    before = spark.conf.get("spark.sql.shuffle.partitions")
    advisory = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        n = size_shuffle_partitions(spark, paths, target_mb=1, expansion=1000.0)
        assert n >= spark.sparkContext.defaultParallelism
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory)
