"""Prediction rows, latest prediction, ordering and reports."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal as D

from pyspark.sql import functions as F

from keepwise import config as C
from keepwise.operators import ordering as ORD
from keepwise.operators import reports as R
from keepwise.operators import scores as S
from keepwise.sources import tables as TB

from .conftest import ts


def preds(spark, rows):
    return spark.createDataFrame(rows, TB.SCHEMAS["churn_predictions"])


def test_latest_prediction_is_the_last_written_of_its_day(spark):
    p = preds(spark, [
        ("10", 1, dt.date(2026, 5, 1), D("0.9000"), "High Risk", "v2.0", ts("2026-05-01 08:00:00")),
        ("11", 1, dt.date(2026, 5, 1), D("0.1000"), "Low Risk", "v1.0", ts("2026-05-01 07:00:00")),
        ("5", 1, dt.date(2026, 4, 1), D("0.5000"), "Medium Risk", "v1.0", ts("2026-05-02 00:00:00")),
        ("7", 2, dt.date(2026, 3, 1), D("0.7500"), "High Risk", "v1.0", None),
        ("8", 2, dt.date(2026, 3, 1), D("0.2500"), "Low Risk", "v1.0", None),
        ("9", 2, dt.date(2026, 7, 1), D("0.2500"), "Low Risk", "v1.0", None),
    ])
    out = {r["customer_id"]: r for r in S.latest_prediction(p, as_of=dt.datetime(2026, 5, 31)).collect()}
    assert out[1]["prediction_id"] == "10" and out[1]["risk_tier"] == "High Risk"
    assert out[2]["prediction_id"] == "8"
    assert {r["prediction_id"] for r in S.latest_prediction(p).collect()} == {"10", "9"}


def test_two_versions_of_one_day_do_not_mix(spark):
    scored = spark.createDataFrame([(i, 0.5) for i in range(300)], "customer_id long, churn_probability double")
    path = TB.scratch_path(spark, "test-versions")
    for version in ("v1.0", "v2.0"):  # written one after the other
        TB.append_predictions(S.prediction_rows(scored, as_of=dt.datetime(2026, 5, 30), model_version=version), path)
    latest = S.latest_prediction(TB.read_predictions(spark, path))
    assert {r["model_version"] for r in latest.collect()} == {"v2.0"}


def test_prediction_rows_tier_before_rounding(spark):
    scored = spark.createDataFrame([(1, 0.69995), (2, 0.7)], "customer_id long, churn_probability double")
    rows = {r["customer_id"]: r for r in S.prediction_rows(scored, as_of=dt.datetime(2026, 5, 31)).collect()}
    assert rows[1]["churn_probability"] == D("0.7000") and rows[1]["risk_tier"] == "Medium Risk"
    assert rows[2]["risk_tier"] == "High Risk"
    assert rows[1]["prediction_date"] == dt.date(2026, 5, 31)
    again = S.prediction_rows(scored, as_of=dt.datetime(2026, 5, 31)).collect()
    assert {r["prediction_id"] for r in again} == {r["prediction_id"] for r in rows.values()}


def test_prediction_store_append_round_trip(spark):
    scored = spark.createDataFrame([(1, 0.2), (2, 0.8)], "customer_id long, churn_probability double")
    path = TB.scratch_path(spark, "test-store")
    TB.append_predictions(S.prediction_rows(scored, as_of=dt.datetime(2026, 5, 30)), path)
    TB.append_predictions(S.prediction_rows(scored, as_of=dt.datetime(2026, 5, 31)), path)
    back = TB.read_predictions(spark, path)
    assert back.count() == 4
    latest = S.latest_prediction(back).collect()
    assert {r["prediction_date"] for r in latest} == {dt.date(2026, 5, 31)}
    # a second batch of the same day is added; a repeated run replaces its own rows only
    more = scored.withColumn("customer_id", F.col("customer_id") + 10)
    for _ in range(2):
        TB.append_predictions(S.prediction_rows(more, as_of=dt.datetime(2026, 5, 31)), path, run_id="evening")
    TB.append_predictions(S.prediction_rows(scored, as_of=dt.datetime(2026, 5, 31), model_version="v2"), path)
    back = TB.read_predictions(spark, path)
    assert back.count() == 8
    assert back.where("model_version = 'v2'").count() == 2
    assert back.schema == TB.SCHEMAS["churn_predictions"]


def test_prediction_ids_are_whole_digests(spark):
    scored = spark.createDataFrame([(i, 0.2) for i in range(50)], "customer_id long, churn_probability double")
    ids = [r["prediction_id"] for r in S.prediction_rows(scored, as_of=dt.datetime(2026, 5, 30)).collect()]
    assert len(set(ids)) == 50 and {len(i) for i in ids} == {32}


def test_jdbc_reads_must_be_split(spark):
    import pytest

    with pytest.raises(ValueError, match="partitionColumn"):
        TB.load_tables(spark, "jdbc:none", fmt="jdbc", options={"numPartitions": "4"})


def test_orphans(spark):
    p = preds(spark, [("1", 1, dt.date(2026, 1, 1), D("0.1"), "Low Risk", "v", None),
                      ("2", 9, dt.date(2026, 1, 1), D("0.1"), "Low Risk", "v", None)])
    c = spark.createDataFrame([(1,)], "customer_id long")
    assert [r["prediction_id"] for r in S.orphan_predictions(p, c).collect()] == ["2"]


def test_global_row_number_matches_sort(spark):
    rnd = random.Random(7)
    data = [(i, rnd.randint(0, 50), rnd.random()) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, g int, v double").repartition(9)
    order = [F.col("g").desc(), F.col("v").asc(), F.col("id").asc()]
    got = sorted((r["rank"], r["id"]) for r in ORD.global_row_number(df, order).collect())
    want = sorted(data, key=lambda t: (-t[1], t[2], t[0]))
    assert [i for _, i in got] == [t[0] for t in want]
    assert [r for r, _ in got] == list(range(1, 3001))


def test_top_n_is_the_head_of_the_global_order(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(50)], "id long, s double").repartition(4)
    top = ORD.top_n(df, [F.col("s").desc()], ["id"], 12, "r").orderBy("r").collect()
    assert [r["id"] for r in top[:5]] == [6, 13, 20, 27, 34] and [r["r"] for r in top] == list(range(1, 13))
    ranked = ORD.global_row_number(df, [F.col("s").desc(), F.col("id").asc()], "r").where("r <= 12").orderBy("r")
    assert [(r["id"], r["r"]) for r in ranked.collect()] == [(r["id"], r["r"]) for r in top]


def test_running_sums_over_partitions(spark):
    rnd = random.Random(3)
    data = [(i, rnd.randint(0, 9), rnd.randint(0, 3 * 10**9)) for i in range(500)]
    df = spark.createDataFrame(data, "id long, g int, n long").repartition(7)
    got = {r["id"]: r["n_before"] for r in ORD.running_sums(df, [F.col("g").desc(), F.col("id").asc()], ["n"]).collect()}
    total, want = 0, {}
    for i, _, n in sorted(data, key=lambda t: (-t[1], t[0])):
        want[i], total = total, total + n
    assert got == want


def test_high_risk_report_filters_after_latest(spark):
    cust = spark.createDataFrame([
        (1, ts("2025-01-01 00:00:00"), "Active", "X", "S", "I", "Pro", 0, "one", "AM-1"),
        (2, ts("2025-01-01 00:00:00"), "Active", "X", "S", "I", "Pro", 0, "two", "AM-1"),
        (3, ts("2025-01-01 00:00:00"), "Churned", "X", "S", "I", "Pro", 0, "three", "AM-1"),
    ], TB.SCHEMAS["customers"])
    p = preds(spark, [
        ("1", 1, dt.date(2026, 5, 1), D("0.9000"), "High Risk", "v", None),
        ("2", 1, dt.date(2026, 5, 2), D("0.2000"), "Low Risk", "v", None),   # latest is low
        ("3", 2, dt.date(2026, 5, 2), D("0.8000"), "High Risk", "v", None),
        ("4", 3, dt.date(2026, 5, 2), D("0.9500"), "High Risk", "v", None),  # churned
        ("5", 2, dt.date(2026, 7, 2), D("0.1000"), "Low Risk", "v", None),  # after the clock
    ])
    empty_u = spark.createDataFrame([], "customer_id long, days_since_last_login int, unique_features_used long")
    fin = spark.createDataFrame([(2, 12.5)], "customer_id long, avg_monthly_revenue double")
    sup = spark.createDataFrame([(2, 4)], "customer_id long, total_tickets long")
    rows = R.rank_report(R.high_risk_report(cust, p, empty_u, fin, sup, dt.datetime(2026, 5, 31))).collect()
    assert [(r["customer_id"], r["report_rank"], r["monthly_value"], r["recent_support_tickets"])
            for r in rows] == [(2, 1, 12.5, 4)]
    assert rows[0]["days_since_last_login"] is None and rows[0]["tenure_days"] == 515


def test_indicator_lift_empty_group_is_null(spark):
    f = spark.createDataFrame([(1, 30, 0, 1, 0), (0, 30, 0, 1, 0), (1, 2, 9, 1, 2)],
                              "churned int, days_since_last_login int, total_tickets long, "
                              "unique_features_used long, late_payments long")
    avail = spark.createDataFrame([(10,)], "features_available long")
    out = {r["indicator"]: r for r in R.indicator_lift(f, avail).collect()}
    assert out["inactive"]["flagged"] == 2 and out["inactive"]["lift"] == 0.5
    assert out["low_adoption"]["flagged"] == 3 and out["low_adoption"]["lift"] is None


def test_revenue_at_risk_and_actions(spark):
    s = spark.createDataFrame([
        (1, "High Risk", 100.0, "Active"), (2, "High Risk", 50.0, "Churned"), (3, "Low Risk", 10.0, "Active"),
    ], "customer_id long, risk_tier string, value double, account_status string")
    r = R.revenue_at_risk(s).first()
    assert (r["high_risk_customers"], r["revenue_at_risk"], r["saved_customers"]) == (2, 150.0, 1)
    assert r["save_rate"] == 0.5 and r["net_revenue_protected"] == 75.0
    acts = {x["risk_tier"]: x["action"] for x in R.recommended_action(s).collect()}
    assert acts == {"High Risk": C.TIER_ACTIONS[0][1], "Low Risk": C.TIER_ACTIONS[2][1]}


def test_sql_views_reproduce_the_report(spark):
    import __spark_entry__ as E
    from keepwise.plans.queries import FIXTURE_CLOCKS, fixture_feature_tables
    from keepwise.plans.views import register_views
    from keepwise.sources import fixtures as fx

    sf = "/root/testdata/sf0.001"
    names = register_views(spark, fixture_feature_tables(spark, sf), FIXTURE_CLOCKS,
                           predictions=fx.churn_predictions(spark, sf))
    assert {"customers", "usage_metrics", "high_risk_report", "latest_predictions"} <= set(names)
    via_sql = spark.sql("""
        SELECT customer_id, churn_probability, monthly_value
        FROM high_risk_report
        ORDER BY churn_probability DESC, monthly_value DESC NULLS LAST, customer_id""").collect()
    ranked = E.queries()["high_risk_report"](spark, sf).orderBy("report_rank").collect()
    assert [r["customer_id"] for r in via_sql] == [r["customer_id"] for r in ranked]
    n = spark.sql("SELECT COUNT(*) FROM customer_features").first()[0]
    assert n == E.queries()["merged_features"](spark, sf).count()
