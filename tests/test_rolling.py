from __future__ import annotations

import datetime as dt
import random

import pytest
from keepwise.operators import features as FT
from keepwise.operators import rolling as RW
from keepwise.sources import tables as TB

DAY = dt.timedelta(days=1)
OLD, NEW = dt.datetime(2026, 1, 3), dt.datetime(2026, 7, 2)


def begin(path, activity, last):
    """The days that hold rows; the others need no state."""
    RW.advance(path, OLD, OLD + 12 * DAY, activity)
    RW.advance(path, NEW, last, activity)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def activity(spark):
    """Sessions that span days, a customer with a third of all rows, a null customer, null values; the rows lie at
    both ends of the half year."""
    rng = random.Random(4)
    rows = []
    for _ in range(900):
        c = 1 if rng.random() < 0.33 else rng.choice([2, 3, 4, 5, None])
        at = rng.choice([OLD, NEW]) + dt.timedelta(minutes=rng.randrange(12 * 1440))
        rows.append((c, rng.choice([None, f"s{rng.randrange(40)}"]), at, rng.choice([None, rng.randrange(6000) / 100]),
                     rng.choice([None, rng.randrange(9)]), rng.choice(["feature_adoption", "view"]), rng.choice([None, rng.randrange(5)])))
    schema = TB.SCHEMAS["user_activity"]
    return spark.createDataFrame([(*r[:3], None if r[3] is None else __import__("decimal").Decimal(str(r[3])), *r[4:]) for r in rows],
                                 schema).repartition(4)


def test_a_day_more_equals_the_full_recomputation(spark, activity):
    """The state of day D plus one day is the recomputation at D + 1, over a window edge that moves."""
    path = TB.scratch_path(spark, "rolling-test")
    clock = dt.datetime(2026, 7, 10)
    begin(path, activity, clock)
    for profile in (FT.FULL, FT.CORE):
        assert rows_of(RW.rolling_usage(spark, path, clock, profile)) == rows_of(FT.usage_metrics(activity, clock, profile))
        assert rows_of(RW.rolling_rollup(spark, path, clock)) == rows_of(FT.activity_rollup(activity, clock))
        RW.advance(path, clock, clock + DAY, activity)
        clock += DAY


def test_only_the_day_is_read_and_days_are_replaced(spark, activity):
    path = TB.scratch_path(spark, "rolling-test")
    clock = dt.datetime(2026, 7, 9)
    begin(path, activity, clock - DAY)
    half = activity.where("customer_id <= 2")
    RW.advance(path, clock - DAY, clock, half)
    RW.advance(path, clock - DAY, clock, activity)
    RW.advance(path, clock - DAY, clock, activity)
    assert rows_of(RW.rolling_usage(spark, path, clock)) == rows_of(FT.usage_metrics(activity, clock))
    # a day that has lost all its rows is replaced by nothing
    RW.advance(path, clock - 4 * DAY, clock, activity.where("false"))
    kept = activity.where(activity.login_date < clock - 4 * DAY)
    assert rows_of(RW.rolling_rollup(spark, path, clock)) == rows_of(FT.activity_rollup(kept, clock))
    with pytest.raises(ValueError):
        RW.advance(path, clock, clock + dt.timedelta(hours=5), activity)


def test_month_ends_and_days_are_pruned(spark, activity):
    path = TB.scratch_path(spark, "rolling-test")
    clock = dt.datetime(2026, 8, 31)  # trend windows end in February, which has no 31st
    begin(path, activity, NEW + 12 * DAY)
    got = RW.rolling_usage(spark, path, clock)
    assert rows_of(got) == rows_of(FT.usage_metrics(activity, clock))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day" in plan.split("PartitionFilters: [")[1][:200]


def test_invoices(spark):
    rng = random.Random(8)
    from decimal import Decimal

    rows = [(rng.choice([1, 1, 2, 3]), rng.choice([None, Decimal(rng.randrange(10**6)) / 100]),
             rng.choice([dt.datetime(2025, 4, 25), dt.datetime(2026, 4, 20)]) + dt.timedelta(hours=rng.randrange(10 * 24)), rng.choice(["Paid", "Late", "Failed", None]))
            for _ in range(400)]
    invoices = spark.createDataFrame(rows, TB.SCHEMAS["invoices"])
    path = TB.scratch_path(spark, "rolling-test")
    clock = dt.datetime(2026, 4, 30)
    RW.advance(path, dt.datetime(2025, 4, 25), dt.datetime(2025, 5, 5), invoices=invoices)
    RW.advance(path, dt.datetime(2026, 4, 20), clock - DAY, invoices=invoices)
    RW.advance(path, clock - DAY, clock, invoices=invoices)
    for profile in (FT.FULL, FT.CORE):
        assert rows_of(RW.rolling_financial(spark, path, clock, profile)) == rows_of(FT.financial_metrics(invoices, clock, profile))
