"""Registered checks of the single operators (sections 2.1 .. 2.8): each
applies one projection, filter, aggregate or scalar helper to whole fixture
tables and has a DuckDB twin."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from .. import config as C
from ..functions import dates
from ..functions import exprs as X
from ..operators import features as FT
from ..sources import fixtures as fx
from ..sources import tables as TB
from . import oracle as O
from .oracle_tables import AS_OF_ORDERS_SQL as OR
from .oracle_tables import with_tables

AS_OF_O = fx.AS_OF_ORDERS
AS_OF_E = fx.AS_OF_EVENTS
QUERIES: dict = {}
ORACLE: dict = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- 2.1 sources and sinks ---------------------------------------------------

_ALL = ["customers", "user_activity", "invoices", "support_tickets", "marketing_engagement", "churn_predictions"]


@register("source_row_counts", with_tables(*_ALL) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in _ALL))
def source_row_counts(spark, d):
    tabs = fx.fixture_tables(spark, d)
    parts = [tabs[t].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
             for t in _ALL]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


@register("csv_round_trip", O.q_merged())
def csv_round_trip(spark, d):
    from .queries import merged_features

    df = merged_features(spark, d)
    path = TB.run_folder(TB.scratch_path(spark, "csv"), AS_OF_O)
    TB.write_csv(df, path)
    return TB.read_csv(spark, path, df.schema)


# --- 2.2 projections, filters, predicates -------------------------------------

@register("filter_recent", with_tables("invoices") + f"""SELECT customer_id, CAST(amount AS DOUBLE) AS amount,
    invoice_date, payment_status FROM invoices WHERE invoice_date >= {O.months_before(OR, 12)}""")
def filter_recent(spark, d):
    inv = fx.invoices(spark, d)
    return inv.where(F.col("invoice_date") >= dates.months_before(AS_OF_O, 12)).select(
        "customer_id", F.col("amount").cast("double").alias("amount"), "invoice_date", "payment_status")


@register("filter_half_open", with_tables("invoices") + f"""SELECT customer_id, CAST(amount AS DOUBLE) AS amount,
    invoice_date FROM invoices
    WHERE invoice_date >= ({O.months_before(OR, 3)} - INTERVAL 6 MONTH) AND invoice_date >= {O.months_before(OR, 9)}
      AND invoice_date < {O.months_before(OR, 3)}""")
def filter_half_open(spark, d):
    lo = F.greatest(dates.nested_months_before(AS_OF_O, 3, 6), dates.months_before(AS_OF_O, 9))
    inv = fx.invoices(spark, d)
    return inv.where(dates.in_window(F.col("invoice_date"), lo, dates.months_before(AS_OF_O, 3))).select(
        "customer_id", F.col("amount").cast("double").alias("amount"), "invoice_date")


@register("filter_conjunction", with_tables("customers") + """SELECT customer_id, company_name, account_status
    FROM customers WHERE is_test_account = 0 AND account_status = 'Active'""")
def filter_conjunction(spark, d):
    c = fx.customers(spark, d)
    return c.where((F.col("is_test_account") == 0) & (F.col("account_status") == C.STATUS_ACTIVE)).select(
        "customer_id", "company_name", "account_status")


@register("churn_label", with_tables("customers") + """SELECT customer_id, account_status,
    CASE WHEN account_status = 'Churned' THEN 1 ELSE 0 END AS churned FROM customers""")
def churn_label(spark, d):
    c = fx.customers(spark, d)
    return c.select("customer_id", "account_status", X.churn_label(F.col("account_status")).alias("churned"))


@register("lifecycle_stage", with_tables("customers") + f"""SELECT customer_id,
    {O.days('signup_date', OR)} AS tenure_days,
    CASE WHEN date_diff('day', signup_date, {OR}) < 90 THEN 'New'
         WHEN date_diff('day', signup_date, {OR}) < 365 THEN 'Growing' ELSE 'Established' END AS customer_lifecycle_stage
    FROM customers""")
def lifecycle_stage(spark, d):
    c = fx.customers(spark, d)
    tenure = dates.day_diff(F.col("signup_date"), dates.as_of_literal(AS_OF_O))
    return c.select("customer_id", tenure.alias("tenure_days"), X.lifecycle_stage(tenure).alias("customer_lifecycle_stage"))


@register("risk_tier", with_tables("churn_predictions") + """SELECT prediction_id,
    CAST(churn_probability AS DOUBLE) AS churn_probability,
    CASE WHEN churn_probability >= 0.7 THEN 'High Risk' WHEN churn_probability >= 0.4 THEN 'Medium Risk'
         ELSE 'Low Risk' END AS risk_tier FROM churn_predictions""")
def risk_tier(spark, d):
    p = fx.churn_predictions(spark, d)
    prob = F.col("churn_probability").cast("double")
    return p.select("prediction_id", prob.alias("churn_probability"), X.risk_tier(prob).alias("risk_tier"))


@register("guarded_ratio", with_tables("customers", "invoices") + f"""SELECT c.customer_id,
    {O.ratio('i.late', 'i.n')} AS late_payment_share
    FROM customers c LEFT JOIN (SELECT customer_id, COUNT(*) AS n,
        SUM(CASE WHEN payment_status = 'Late' THEN 1 ELSE 0 END) AS late FROM invoices GROUP BY customer_id) i
    ON c.customer_id = i.customer_id""")
def guarded_ratio(spark, d):
    inv = fx.invoices(spark, d).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), X.count_when(F.col("payment_status") == C.PAYMENT_LATE).alias("late"))
    c = fx.customers(spark, d).select("customer_id")
    return c.join(inv, "customer_id", "left").select(
        "customer_id", X.safe_ratio(F.col("late"), F.col("n")).alias("late_payment_share"))


@register("relative_change", with_tables("invoices") + f"""SELECT customer_id, recent, previous,
    CASE WHEN previous > 0 THEN (recent - previous) / previous ELSE 0.0 END AS change
    FROM (SELECT customer_id,
            {O.mean("CASE WHEN year(invoice_date) = 2000 THEN amount END")} AS recent,
            {O.mean("CASE WHEN year(invoice_date) = 1999 THEN amount END")} AS previous
          FROM invoices GROUP BY customer_id) t""")
def relative_change(spark, d):
    inv = fx.invoices(spark, d)
    y = F.year("invoice_date")
    g = inv.groupBy("customer_id").agg(X.mean_when(y == 2000, F.col("amount")).alias("recent"),
                                       X.mean_when(y == 1999, F.col("amount")).alias("previous"))
    return g.select("customer_id", "recent", "previous",
                    X.relative_change(F.col("recent"), F.col("previous")).alias("change"))


@register("coalesce_zero", with_tables("customers", "user_activity") + f"""SELECT
    c.customer_id, COALESCE(u.total_sessions, 0) AS total_sessions, COALESCE(u.total_api_calls, 0) AS total_api_calls
    FROM customers c LEFT JOIN ({O.usage_sql('full')}) u ON c.customer_id = u.customer_id""")
def coalesce_zero(spark, d):
    u = FT.usage_metrics(fx.user_activity(spark, d), AS_OF_E, FT.FULL)
    c = fx.customers(spark, d).select("customer_id")
    return c.join(u, "customer_id", "left").select(
        "customer_id", X.coalesce_zero(F.col("total_sessions")).alias("total_sessions"),
        X.coalesce_zero(F.col("total_api_calls")).alias("total_api_calls"))


@register("fill_numeric_nulls", with_tables("customers", "support_tickets") + f"""SELECT c.customer_id, c.company_name,
    COALESCE(s.total_tickets, 0) AS total_tickets, COALESCE(s.avg_resolution_hours, 0.0) AS avg_resolution_hours,
    COALESCE(s.high_priority_tickets, 0) AS high_priority_tickets, COALESCE(s.escalated_tickets, 0) AS escalated_tickets,
    s.last_ticket_date
    FROM customers c LEFT JOIN ({O.support_sql('core')}) s ON c.customer_id = s.customer_id""")
def fill_numeric_nulls(spark, d):
    from .queries import tickets_for_window

    s = FT.support_metrics(tickets_for_window(spark, d), AS_OF_O, FT.CORE)
    c = fx.customers(spark, d).select("customer_id", "company_name")
    return X.fill_numeric_nulls(c.join(s, "customer_id", "left"))


_FEATURE_SQL_COLS = [c for c in O.MERGED_ORDER_CORE if c not in C.EXCLUDED_FEATURE_COLUMNS]


@register("feature_columns")
def feature_columns(spark, d):
    from .queries import merged_features

    return X.select_excluding(merged_features(spark, d))


ORACLE["feature_columns"] = (
    with_tables("customers", "user_activity", "invoices", "support_tickets", "marketing_engagement",
                extra=O.merged_ctes("core") + [f"merged AS ({O.merged_select()})"])
    + f"SELECT {', '.join(_FEATURE_SQL_COLS)} FROM merged"
)


# --- 2.4 aggregations -----------------------------------------------------------

def _per_customer(table: str, select: str) -> str:
    return with_tables(table) + f"SELECT customer_id, {select} FROM {table} GROUP BY customer_id"


@register("agg_count", _per_customer("support_tickets", "COUNT(*) AS tickets"))
def agg_count(spark, d):
    return fx.support_tickets(spark, d).groupBy("customer_id").agg(F.count(F.lit(1)).alias("tickets"))


@register("agg_count_distinct", _per_customer(
    "user_activity", "COUNT(DISTINCT session_id) AS sessions, COUNT(DISTINCT feature_id) AS features"))
def agg_count_distinct(spark, d):
    return fx.user_activity(spark, d).groupBy("customer_id").agg(
        F.countDistinct("session_id").alias("sessions"), F.countDistinct("feature_id").alias("features"))


@register("agg_active_days", _per_customer("user_activity", "COUNT(DISTINCT CAST(login_date AS DATE)) AS active_days"))
def agg_active_days(spark, d):
    return fx.user_activity(spark, d).groupBy("customer_id").agg(
        F.countDistinct(dates.to_day(F.col("login_date"))).alias("active_days"))


@register("agg_sum", _per_customer("invoices", "CAST(SUM(amount) AS DOUBLE) AS total_amount"))
def agg_sum(spark, d):
    return fx.invoices(spark, d).groupBy("customer_id").agg(F.sum("amount").cast("double").alias("total_amount"))


@register("agg_avg", _per_customer("invoices", f"{O.mean('amount')} AS avg_amount"))
def agg_avg(spark, d):
    return fx.invoices(spark, d).groupBy("customer_id").agg(X.exact_mean(F.col("amount")).alias("avg_amount"))


@register("agg_max_date", _per_customer("invoices", "MAX(invoice_date) AS last_invoice_date"))
def agg_max_date(spark, d):
    return fx.invoices(spark, d).groupBy("customer_id").agg(F.max("invoice_date").alias("last_invoice_date"))


def _status_is(status: str) -> str:
    return f"payment_status = '{status}'"


@register("agg_conditional_count", _per_customer("invoices", ", ".join([
    f"{O.many(_status_is(s))} AS {s.lower()}_payments" for s in ("Late", "Failed", "Paid")])))
def agg_conditional_count(spark, d):
    st = F.col("payment_status")
    return fx.invoices(spark, d).groupBy("customer_id").agg(
        *[X.count_when(st == s).alias(f"{s.lower()}_payments") for s in ("Late", "Failed", "Paid")])


@register("agg_conditional_avg", _per_customer("invoices", ", ".join([
    f"{O.mean(f'CASE WHEN {_status_is(s)} THEN amount END')} AS avg_{s.lower()}_amount"
    for s in ("Late", "Paid")])))
def agg_conditional_avg(spark, d):
    st = F.col("payment_status")
    return fx.invoices(spark, d).groupBy("customer_id").agg(
        *[X.mean_when(st == s, F.col("amount")).alias(f"avg_{s.lower()}_amount") for s in ("Late", "Paid")])


@register("agg_avg_resolution_hours", _per_customer(
    "support_tickets", f"{O.mean(O.hours('created_date', 'resolved_date'))} AS avg_resolution_hours"))
def agg_avg_resolution_hours(spark, d):
    return fx.support_tickets(spark, d).groupBy("customer_id").agg(
        X.exact_mean(dates.hour_diff(F.col("created_date"), F.col("resolved_date"))).alias("avg_resolution_hours"))


@register("agg_ratio", _per_customer("marketing_engagement", ", ".join([
    f"{O.ratio('SUM(CASE WHEN opened = 1 THEN 1 ELSE 0 END)', 'COUNT(*)')} AS open_rate",
    f"{O.ratio('SUM(CASE WHEN clicked = 1 THEN 1 ELSE 0 END)', 'SUM(CASE WHEN opened = 1 THEN 1 ELSE 0 END)')}"
    " AS click_through_rate"])))
def agg_ratio(spark, d):
    opened = X.count_when(F.col("opened") == 1)
    clicked = X.count_when(F.col("clicked") == 1)
    return fx.marketing_engagement(spark, d).groupBy("customer_id").agg(
        X.safe_ratio(opened, F.count(F.lit(1))).alias("open_rate"),
        X.safe_ratio(clicked, opened).alias("click_through_rate"))


# --- 2.8 scalar functions --------------------------------------------------------

@register("fn_as_of", with_tables("customers") + f"""SELECT customer_id, {OR} AS as_of,
    CASE WHEN signup_date < {OR} THEN 1 ELSE 0 END AS signed_up_before FROM customers""")
def fn_as_of(spark, d):
    clock = dates.as_of_literal(AS_OF_O)
    return fx.customers(spark, d).select("customer_id", clock.alias("as_of"),
                                         X.flag(F.col("signup_date") < clock).alias("signed_up_before"))


@register("fn_date_add", with_tables("customers") + """SELECT customer_id, signup_date,
    signup_date - INTERVAL 1 MONTH AS minus_1_month, signup_date + INTERVAL 6 MONTH AS plus_6_months,
    signup_date - INTERVAL 2 YEAR AS minus_2_years FROM customers""")
def fn_date_add(spark, d):
    s = F.col("signup_date")
    return fx.customers(spark, d).select(
        "customer_id", "signup_date", dates.shift(s, "MONTH", -1).alias("minus_1_month"),
        dates.shift(s, "MONTH", 6).alias("plus_6_months"), dates.shift(s, "YEAR", -2).alias("minus_2_years"))


@register("fn_date_add_nested", with_tables("customers") + """SELECT customer_id,
    (signup_date - INTERVAL 1 MONTH) - INTERVAL 3 MONTH AS nested_1_then_3,
    signup_date - INTERVAL 4 MONTH AS summed_4 FROM customers""")
def fn_date_add_nested(spark, d):
    s = F.col("signup_date")
    return fx.customers(spark, d).select(
        "customer_id", dates.shift(dates.shift(s, "MONTH", -1), "MONTH", -3).alias("nested_1_then_3"),
        dates.shift(s, "MONTH", -4).alias("summed_4"))


@register("fn_date_diff_days", with_tables("support_tickets") + f"""SELECT customer_id, created_date, resolved_date,
    {O.days('created_date', 'resolved_date')} AS resolution_days FROM support_tickets""")
def fn_date_diff_days(spark, d):
    return fx.support_tickets(spark, d).select(
        "customer_id", "created_date", "resolved_date",
        dates.day_diff(F.col("created_date"), F.col("resolved_date")).alias("resolution_days"))


@register("fn_date_diff_hours", with_tables("support_tickets") + f"""SELECT customer_id, created_date, resolved_date,
    {O.hours('created_date', 'resolved_date')} AS resolution_hours FROM support_tickets""")
def fn_date_diff_hours(spark, d):
    return fx.support_tickets(spark, d).select(
        "customer_id", "created_date", "resolved_date",
        dates.hour_diff(F.col("created_date"), F.col("resolved_date")).alias("resolution_hours"))


@register("fn_run_stamp", with_tables("invoices") + """SELECT strftime(invoice_date, '%Y%m%d') AS run_stamp,
    COUNT(*) AS invoices FROM invoices GROUP BY 1""")
def fn_run_stamp(spark, d):
    return fx.invoices(spark, d).groupBy(dates.run_stamp(F.col("invoice_date")).alias("run_stamp")).agg(
        F.count(F.lit(1)).alias("invoices"))

