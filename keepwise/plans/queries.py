"""Registered queries: ``name -> callable(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables through the fixture adapters and runs
over whole tables. Output columns carry the same names and types as the
matching oracle SQL (counts bigint, means and ratios double, money cast to
double after exact decimal sums, day counts int).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import features as FT
from ..operators import reports as R
from ..sources import fixtures as fx
from . import oracle as O

QueryFn = Callable[[SparkSession, str], DataFrame]
AS_OF_O = fx.AS_OF_ORDERS
AS_OF_E = fx.AS_OF_EVENTS
FIXTURE_CLOCKS = FT.Clocks(customers=AS_OF_O, activity=AS_OF_E, invoices=AS_OF_O, tickets=AS_OF_O,
                           marketing=AS_OF_E)


def tickets_for_window(spark: SparkSession, d: str, months: int = 6, as_of=AS_OF_O) -> DataFrame:
    """Tickets with the adapter's l_shipdate pre-filter for a window ending at
    ``as_of`` (so the lineitem scan is pruned)."""
    import datetime as dt

    since = FT.as_datetime(as_of)
    # a month is at most 31 days; the adapter widens by another day itself
    since = since - dt.timedelta(days=31 * months)
    return fx.support_tickets(spark, d, since=since, until=as_of)


def fixture_feature_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "customers": fx.customers(spark, d),
        "user_activity": fx.user_activity(spark, d),
        "invoices": fx.invoices(spark, d),
        "support_tickets": tickets_for_window(spark, d),
        "marketing_engagement": fx.marketing_engagement(spark, d),
    }


# --- composite feature sets -------------------------------------------------

def customer_base(spark, d):
    return FT.customer_base(fx.customers(spark, d), AS_OF_O, FT.FULL)


def customer_base_core(spark, d):
    return FT.customer_base(fx.customers(spark, d), AS_OF_O, FT.CORE)


def usage_metrics(spark, d):
    return FT.usage_metrics(fx.user_activity(spark, d), AS_OF_E, FT.FULL)


def usage_metrics_core(spark, d):
    return FT.usage_metrics(fx.user_activity(spark, d), AS_OF_E, FT.CORE)


def financial_metrics(spark, d):
    return FT.financial_metrics(fx.invoices(spark, d), AS_OF_O, FT.FULL)


def financial_metrics_core(spark, d):
    return FT.financial_metrics(fx.invoices(spark, d), AS_OF_O, FT.CORE)


def support_metrics(spark, d):
    return FT.support_metrics(tickets_for_window(spark, d), AS_OF_O, FT.FULL)


def support_metrics_core(spark, d):
    return FT.support_metrics(tickets_for_window(spark, d), AS_OF_O, FT.CORE)


def marketing_metrics(spark, d):
    return FT.marketing_metrics(fx.marketing_engagement(spark, d), AS_OF_E, FT.FULL)


def marketing_metrics_core(spark, d):
    return FT.marketing_metrics(fx.marketing_engagement(spark, d), AS_OF_E, FT.CORE)


def merged_features(spark, d):
    return FT.build_features(fixture_feature_tables(spark, d), FIXTURE_CLOCKS, FT.CORE)


def merged_features_full(spark, d):
    """The five SQL-file feature sets merged (44 columns)."""
    return FT.build_features(fixture_feature_tables(spark, d), FIXTURE_CLOCKS, FT.FULL)


def high_risk_report(spark, d):
    return R.rank_report(R.high_risk_report(
        fx.customers(spark, d),
        fx.churn_predictions(spark, d),
        FT.usage_metrics(fx.user_activity(spark, d), AS_OF_E, FT.FULL),
        FT.financial_metrics(fx.invoices(spark, d), AS_OF_O, FT.FULL),
        FT.support_metrics(tickets_for_window(spark, d), AS_OF_O, FT.FULL),
        AS_OF_O,
    ))


QUERIES: dict[str, QueryFn] = {
    "customer_base": customer_base,
    "customer_base_core": customer_base_core,
    "usage_metrics": usage_metrics,
    "usage_metrics_core": usage_metrics_core,
    "financial_metrics": financial_metrics,
    "financial_metrics_core": financial_metrics_core,
    "support_metrics": support_metrics,
    "support_metrics_core": support_metrics_core,
    "marketing_metrics": marketing_metrics,
    "marketing_metrics_core": marketing_metrics_core,
    "merged_features": merged_features,
    "merged_features_full": merged_features_full,
    "high_risk_report": high_risk_report,
}


ORACLE: dict[str, str] = {
    "customer_base": O.q_customer_base("full"),
    "customer_base_core": O.q_customer_base("core"),
    "usage_metrics": O.q_usage("full"),
    "usage_metrics_core": O.q_usage("core"),
    "financial_metrics": O.q_financial("full"),
    "financial_metrics_core": O.q_financial("core"),
    "support_metrics": O.q_support("full"),
    "support_metrics_core": O.q_support("core"),
    "marketing_metrics": O.q_marketing("full"),
    "marketing_metrics_core": O.q_marketing("core"),
    "merged_features": O.q_merged(),
    "merged_features_full": O.q_merged("full"),
    "high_risk_report": O.q_high_risk_report(),
}
