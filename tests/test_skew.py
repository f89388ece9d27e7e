"""A customer holding a third of all rows: results against brute force, and
map-side combining before every shuffle on the customer key."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from keepwise.operators import features as FT
from keepwise.operators import scores as S
from keepwise.sources.tables import SCHEMAS

AS_OF = dt.datetime(2026, 5, 31)


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(11)
    rows = []
    start = AS_OF - dt.timedelta(days=200)
    for i in range(6000):
        cust = 7 if i % 3 == 0 else rnd.randint(100, 400)  # customer 7 owns a third
        t = start + dt.timedelta(minutes=rnd.randint(0, 200 * 24 * 60 - 1))
        rows.append((cust, f"{cust}-{t:%Y%m%d%H}", t, D(f"{rnd.randint(0, 9999) / 100:.2f}"),
                     rnd.randint(0, 40), rnd.choice(["login", "feature_adoption", "view"]), rnd.randint(0, 9)))
    return rows, spark.createDataFrame(rows, SCHEMAS["user_activity"]).repartition(6)


def brute_usage(rows):
    lo = dt.datetime(2025, 11, 30)  # six months before May 31
    m1, prev_lo = dt.datetime(2026, 4, 30), max(dt.datetime(2026, 1, 30), dt.datetime(2026, 1, 31))
    acc = defaultdict(lambda: {"s": set(), "d": set(), "f": set(), "n": 0, "sum": D(0), "last": None,
                               "adopt": 0, "api": 0, "r": [], "p": []})
    for c, sess, t, dur, feat, ev, api in rows:
        if not (lo <= t < AS_OF):
            continue
        a = acc[c]
        a["s"].add(sess), a["d"].add(t.date()), a["f"].add(feat)
        a["n"] += 1
        a["sum"] += dur
        a["last"] = t if a["last"] is None or t > a["last"] else a["last"]
        a["adopt"] += ev == "feature_adoption"
        a["api"] += api
        if t >= m1:
            a["r"].append(dur)
        elif t >= prev_lo:
            a["p"].append(dur)
    out = {}
    for c, a in acc.items():
        r = float(sum(a["r"])) / len(a["r"]) if a["r"] else None
        p = float(sum(a["p"])) / len(a["p"]) if a["p"] else None
        trend = 0.0 if not (p and p > 0) else (None if r is None else (r - p) / p)
        out[c] = (len(a["s"]), len(a["d"]), float(a["sum"]) / a["n"], (AS_OF.date() - a["last"].date()).days,
                  len(a["f"]), a["adopt"], a["api"], trend)
    return out


def test_usage_with_hot_customer_matches_brute_force(spark, skewed):
    rows, df = skewed
    got = {r["customer_id"]: (r["total_sessions"], r["active_days"], r["avg_session_duration"],
                              r["days_since_last_login"], r["unique_features_used"], r["feature_adoptions"],
                              r["total_api_calls"], r["session_duration_trend"])
           for r in FT.usage_metrics(df, AS_OF).collect()}
    want = brute_usage(rows)
    assert set(got) == set(want)
    for c in want:
        g, w = got[c], want[c]
        assert g[:2] == w[:2] and g[3:7] == w[3:7], c
        assert g[2] == pytest.approx(w[2], rel=1e-12)
        assert (g[7] is None and w[7] is None) or g[7] == pytest.approx(w[7], rel=1e-9)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_customer_aggregates_combine_before_shuffle(spark, skewed):
    _, df = skewed
    for out in (FT.usage_metrics(df, AS_OF), FT.activity_rollup(df, AS_OF)):
        plan = physical(out)
        assert "partial_" in plan
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "Exchange hashpartitioning(customer_id" in line and i + 1 < len(lines):
                assert "Aggregate" in lines[i + 1] and "partial_" in lines[i + 1], lines[i + 1]


def test_latest_prediction_with_hot_customer(spark):
    rows = [(f"{i:05d}", 7 if i % 3 == 0 else i, dt.date(2026, 1, 1) + dt.timedelta(days=i % 97), D("0.5000"),
             "Medium Risk", "v1.0", None) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMAS["churn_predictions"]).repartition(5)
    got = {r["customer_id"]: r["prediction_id"] for r in S.latest_prediction(df).collect()}
    hot = max((r for r in rows if r[1] == 7), key=lambda r: (r[2], r[0]))
    assert got[7] == hot[0] and len(got) == len({r[1] for r in rows})
    plan = physical(S.latest_prediction(df))
    assert "partial_max_by" in plan


def test_global_row_number_splits_a_hot_key(spark):
    from keepwise.operators import ordering as ORD

    rows = [(i, 1.0 if i % 3 == 0 else float(i)) for i in range(3000)]  # a third share one key
    df = spark.createDataFrame(rows, "id long, v double").repartition(6)
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # keep the sort's partitions visible
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        ranked = ORD.global_row_number(df, [F.col("v").desc(), F.col("id").asc()], "r")
    finally:
        spark.conf.set(key, before)
    got = ranked.select("r", "v").collect()
    assert sorted(r["r"] for r in got) == list(range(1, 3001))
    by_rank = [r["v"] for r in sorted(got, key=lambda r: r["r"])]
    assert by_rank == sorted((v for _, v in rows), reverse=True)
    per_part = ranked.where("v = 1.0").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_part) > 1  # the hot key is spread, not held by one partition
