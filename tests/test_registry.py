"""Every registered query against its DuckDB twin (sf0.001), the entry
smoke check, and plan properties (pushdown, no cartesian products)."""

from __future__ import annotations

import math
import re

import pytest

import __spark_entry__ as E
from keepwise.plans import registry

from .conftest import SF_SMALL

QUERIES, ORACLE = registry.queries(), registry.oracle_sql()
MODEL_KEYS = {"train_forest", "cross_validated_auc", "score_batch", "model_save_load", "feature_importance",
              "stream_scoring", "daily_scoring", "scaler_stats", "forest_nodes", "forest_node_scores",
              "forest_node_importance", "forest_audit", "cross_validated_small_forest", "stream_daily_once"}
#: Keys that write a store or state before they read it back.
STATE_KEYS = {k for k in QUERIES if k.startswith(("rolling_", "maintained_"))} | {"checked_append", "merged_features_bucketed"}


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def test_every_key_has_callable_and_sql():
    assert set(ORACLE) == set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    srows = sorted("|".join(canon(r[c]) for c in cols) for r in df.collect())
    rel = duck.sql(ORACLE[key])
    assert sorted(rel.columns) == cols
    drows = sorted("|".join(canon(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall())
    assert srows == drows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "report_rank" in df.columns


def physical(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["usage_metrics", "financial_metrics", "marketing_metrics", "support_metrics",
                                 "customer_base"])
def test_date_filters_reach_the_scan(spark, key):
    plan = physical(QUERIES[key](spark, SF_SMALL))
    assert "PushedFilters: [" in plan
    pushed = [ln for ln in plan.splitlines() if "PushedFilters" in ln]
    assert any("GreaterThanOrEqual" in ln and "LessThan" in ln for ln in pushed), pushed


@pytest.mark.parametrize("key", sorted(set(QUERIES) - MODEL_KEYS - STATE_KEYS - {"csv_round_trip", "prediction_store",
                                                                                    "high_risk_report"}))
def test_no_cartesian_product(spark, key):
    plan = physical(QUERIES[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_projection_is_pruned(spark):
    plan = physical(QUERIES["financial_metrics"](spark, SF_SMALL))
    schema = [ln for ln in plan.splitlines() if "ReadSchema" in ln][0]
    assert "o_orderpriority" not in schema and "o_orderkey" not in schema


# Windows are allowed only where their input is bounded: after a top-N limit, over one row per class, within a
# range of scores and over the sums of the (at most 65,538) ranges, over the hash buckets of a class.
CURVE_KEYS = {"eval_auc", "roc_curve", "roc_curve_corners"}
STRATA_KEYS = {"stratified_split", "stratified_folds"}
BOUNDED_WINDOW_KEYS = {"top_risk_customers", "class_weights"} | CURVE_KEYS | STRATA_KEYS


@pytest.mark.parametrize("key", sorted(set(QUERIES) - MODEL_KEYS - STATE_KEYS - {"csv_round_trip", "prediction_store",
                                                                                    "high_risk_report"}))
def test_windows_only_over_bounded_inputs(spark, key):
    plan = physical(QUERIES[key](spark, SF_SMALL))
    if key not in BOUNDED_WINDOW_KEYS:
        assert "Window" not in plan
    elif key == "top_risk_customers":
        assert "TakeOrderedAndProject(limit=100" in plan
    elif key != "class_weights":
        over = set(re.findall(r"windowspecdefinition\((\w+?)#", plan))
        assert over == ({"cell"} if key in CURVE_KEYS else {"_y", "_cy"}), plan
        # what an unpartitioned window runs over has been summed up by range before
        assert key in STRATA_KEYS or re.search(r"Aggregate\(keys?=\[cell#", plan)


def test_adoption_share_scans_activity_once(spark):
    df = QUERIES["feature_adoption_share"](spark, SF_SMALL)
    df.collect()
    assert re.search(r"ReusedExchange \[customer_id#\d+L, feature_id#\d+\]", physical(df))


def test_tier_counts_sum_to_customers(spark):
    tiers = QUERIES["tier_segments"](spark, SF_SMALL).agg({"customers": "sum"}).first()[0]
    latest = QUERIES["latest_prediction"](spark, SF_SMALL).count()
    assert tiers == latest


@pytest.mark.parametrize("full,core", [("usage_metrics", "usage_metrics_core"),
                                       ("financial_metrics", "financial_metrics_core"),
                                       ("support_metrics", "support_metrics_core"),
                                       ("marketing_metrics", "marketing_metrics_core"),
                                       ("customer_base", "customer_base_core")])
def test_full_and_core_agree_on_shared_columns(spark, full, core):
    a = QUERIES[full](spark, SF_SMALL)
    b = QUERIES[core](spark, SF_SMALL)
    shared = [c for c in b.columns if c in a.columns]
    assert len(shared) >= 4
    # the core base has no test-account filter, so it is a superset there
    assert a.select(shared).exceptAll(b.select(shared)).count() == 0
    if full != "customer_base":
        assert b.select(shared).exceptAll(a.select(shared)).count() == 0
