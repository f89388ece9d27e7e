"""Feature sets on hand-made edge rows and invariants on fixture data."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keepwise.operators import features as FT
from keepwise.sources import fixtures as fx
from keepwise.sources.tables import SCHEMAS

from .conftest import SF_SMALL, ts

AS_OF = dt.datetime(2026, 5, 31)


def activity(spark, rows):
    return spark.createDataFrame(rows, SCHEMAS["user_activity"])


def test_usage_trend_edges(spark):
    from decimal import Decimal as D

    rows = [
        # customer 1: recent and previous sessions -> trend (30 - 10) / 10 = 2
        (1, "s1", ts("2026-05-20 10:00:00"), D("30.00"), 1, "login", 2),
        (1, "s2", ts("2026-03-10 10:00:00"), D("10.00"), 2, "feature_adoption", 3),
        # customer 2: nothing in the last month -> trend NULL
        (2, "s3", ts("2026-03-10 10:00:00"), D("5.00"), 1, "login", 1),
        # customer 3: only recent -> previous missing -> 0
        (3, "s4", ts("2026-05-30 23:00:00"), D("7.00"), 1, "login", 1),
        # customer 4: previous average zero -> 0
        (4, "s5", ts("2026-05-30 23:00:00"), D("7.00"), 1, "login", 1),
        (4, "s6", ts("2026-03-01 00:00:00"), D("0.00"), 1, "login", 1),
        # on the clock itself and just before the window: excluded
        (5, "s7", ts("2026-05-31 00:00:00"), D("1.00"), 1, "login", 1),
        (5, "s8", ts("2025-11-29 23:59:59"), D("1.00"), 1, "login", 1),
    ]
    out = {r["customer_id"]: r for r in FT.usage_metrics(activity(spark, rows), AS_OF).collect()}
    assert out[1]["session_duration_trend"] == 2.0
    assert out[1]["feature_adoptions"] == 1 and out[1]["total_api_calls"] == 5
    assert out[2]["session_duration_trend"] is None
    assert out[3]["session_duration_trend"] == 0.0
    assert out[4]["session_duration_trend"] == 0.0
    assert 5 not in out
    assert out[1]["days_since_last_login"] == 11


def test_previous_window_uses_later_lower_bound(spark):
    from decimal import Decimal as D

    # as_of May 31: nested bound is Jan 30, pre-filter bound is Jan 31.
    rows = [(1, "a", ts("2026-01-30 12:00:00"), D("100.00"), 1, "x", 0),
            (1, "b", ts("2026-02-15 12:00:00"), D("10.00"), 1, "x", 0),
            (1, "c", ts("2026-05-15 12:00:00"), D("20.00"), 1, "x", 0)]
    r = FT.usage_metrics(activity(spark, rows), AS_OF).first()
    assert r["session_duration_trend"] == 1.0  # previous = 10 only


def test_financial_trend_and_rates(spark):
    from decimal import Decimal as D

    inv = spark.createDataFrame([
        (1, D("100.00"), ts("2026-05-01 00:00:00"), "Paid"),
        (1, D("50.00"), ts("2025-12-01 00:00:00"), "Late"),
        (2, D("80.00"), ts("2025-12-01 00:00:00"), "Failed"),
    ], SCHEMAS["invoices"])
    out = {r["customer_id"]: r for r in FT.financial_metrics(inv, AS_OF).collect()}
    assert out[1]["total_revenue"] == 150.0 and out[1]["avg_monthly_revenue"] == 75.0
    assert out[1]["payment_success_rate"] == 0.5 and out[1]["late_payments"] == 1
    assert out[1]["revenue_trend"] == 1.0
    assert out[2]["revenue_trend"] is None  # empty recent window
    assert out[2]["payment_success_rate"] == 0.0


def test_support_unresolved_and_hour_boundaries(spark):
    tk = spark.createDataFrame([
        (1, ts("2026-05-01 10:59:00"), ts("2026-05-01 11:01:00"), "High", "Resolved", 5),
        (1, ts("2026-05-02 10:00:00"), None, "Critical", "Open", None),
        (1, ts("2026-05-03 10:00:00"), ts("2026-05-03 13:30:00"), "Low", "Reopened", 3),
    ], SCHEMAS["support_tickets"])
    r = FT.support_metrics(tk, AS_OF).first()
    assert r["total_tickets"] == 3
    assert r["avg_resolution_hours"] == 2.0  # (1 + 3) / 2, the open ticket skipped
    assert r["avg_satisfaction_score"] == 4.0
    assert r["critical_tickets"] == 1 and r["reopened_tickets"] == 1
    assert r["resolution_rate"] == pytest.approx(1 / 3)


def test_click_without_open_exceeds_one(spark):
    me = spark.createDataFrame([
        (1, ts("2026-05-01 00:00:00"), 1, 1, 0, 9, 1),
        (1, ts("2026-05-02 00:00:00"), 0, 1, 0, 7, 2),
    ], SCHEMAS["marketing_engagement"])
    r = FT.marketing_metrics(me, AS_OF).first()
    assert r["click_through_rate"] == 2.0 and r["open_rate"] == 0.5 and r["campaigns_engaged"] == 2


def test_merged_keeps_customer_without_facts_and_zero_fills(spark):
    cust = spark.createDataFrame([
        (1, ts("2025-01-01 00:00:00"), "Active", "X", "Small", "I", "Pro", 0, "c1", "AM-1"),
        (2, ts("2025-06-01 00:00:00"), "Churned", "X", "Small", "I", "Pro", 0, "c2", "AM-1"),
        (None, ts("2025-06-01 00:00:00"), "Churned", "X", "Small", "I", "Pro", 0, "c3", "AM-1"),
    ], SCHEMAS["customers"])
    empty = {n: spark.createDataFrame([], SCHEMAS[n]) for n in
             ("user_activity", "invoices", "support_tickets", "marketing_engagement")}
    m = FT.build_features({"customers": cust, **empty}, AS_OF)
    rows = m.collect()
    assert len(rows) == 3
    assert len(m.columns) == 32
    r = [x for x in rows if x["customer_id"] == 2][0]
    assert r["total_sessions"] == 0 and r["days_since_last_login"] == 0 and r["churned"] == 1
    assert r["last_invoice_date"] is None
    m2 = FT.build_features({"customers": cust, **empty}, AS_OF, recency_fill=183)
    assert m2.where("customer_id = 2").first()["days_since_last_login"] == 183


def test_one_pass_equals_two_pass_on_fixture(spark):
    from bench import usage_two_pass

    a = FT.usage_metrics(fx.user_activity(spark, SF_SMALL), fx.AS_OF_EVENTS)
    b = usage_two_pass(spark, SF_SMALL).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_merged_rows_equal_base_rows(spark):
    from keepwise.plans.queries import merged_features

    m = merged_features(spark, SF_SMALL)
    base = FT.customer_base(fx.customers(spark, SF_SMALL), fx.AS_OF_ORDERS, FT.CORE)
    assert m.count() == base.count()
    assert m.select("customer_id").distinct().count() == m.count()


def test_result_independent_of_partitioning(spark):
    acts = fx.user_activity(spark, SF_SMALL)
    a = FT.usage_metrics(acts, fx.AS_OF_EVENTS)
    b = FT.usage_metrics(acts.repartition(7, F.rand(3)), fx.AS_OF_EVENTS)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_unknown_profile_rejected(spark):
    with pytest.raises(ValueError):
        FT.customer_base(fx.customers(spark, SF_SMALL), AS_OF, "other")


def test_load_tables_round_trip(spark):
    from keepwise.sources import tables as TB

    base = TB.scratch_path(spark, "test-load")
    tabs = {"customers": fx.customers(spark, SF_SMALL), "invoices": fx.invoices(spark, SF_SMALL)}
    for name, df in tabs.items():
        df.write.parquet(f"{base}/{name}")
    loaded = TB.load_tables(spark, base, names=("customers", "invoices"))
    for name, df in tabs.items():
        assert loaded[name].schema == TB.SCHEMAS[name]
        assert loaded[name].exceptAll(df.select(*loaded[name].columns)).count() == 0
    # CSV edge: header plus explicit schema
    TB.write_csv(tabs["invoices"], f"{base}/csv/invoices")
    back = TB.load_tables(spark, f"{base}/csv", names=("invoices",), fmt="csv")["invoices"]
    assert back.exceptAll(tabs["invoices"]).count() == 0


def test_approximate_distinct_counts_close(spark):
    acts = fx.user_activity(spark, SF_SMALL)
    exact = {r["customer_id"]: r for r in FT.usage_metrics(acts, fx.AS_OF_EVENTS).collect()}
    approx = {r["customer_id"]: r for r in FT.usage_metrics(acts, fx.AS_OF_EVENTS, approx_rsd=0.01).collect()}
    assert set(exact) == set(approx)
    for c, r in exact.items():
        for k in ("total_sessions", "active_days", "unique_features_used"):
            assert abs(approx[c][k] - r[k]) <= max(2, 0.05 * r[k])
        assert approx[c]["avg_session_duration"] == r["avg_session_duration"]


def test_active_days_against_a_plain_count(spark):
    import datetime as dt

    from keepwise.operators.features import usage_metrics
    from keepwise.sources.tables import SCHEMAS

    rows, want = [], {}
    for c in range(6):
        for k in range(0, 200, c + 1):
            at = dt.datetime(2026, 5, 31) - dt.timedelta(hours=17 * k + c)
            rows.append((c, f"s{k}", at, None, 1, "view", 1))
            if dt.datetime(2025, 11, 30) <= at < dt.datetime(2026, 5, 31):
                want.setdefault(c, set()).add(at.date())
    rows.append((0, "edge", dt.datetime(2025, 11, 30), None, 1, "view", 1))  # first instant of the window
    want[0].add(dt.date(2025, 11, 30))
    df = spark.createDataFrame(rows, SCHEMAS["user_activity"])
    got = {r["customer_id"]: r["active_days"] for r in usage_metrics(df, dt.datetime(2026, 5, 31)).collect()}
    assert got == {c: len(d) for c, d in want.items()}
