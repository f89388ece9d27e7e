"""Per-customer feature sets evaluated as of a clock (Q1 .. Q6).

Each set is a single grouped aggregation on ``customer_id`` over a date range
that Catalyst pushes into the scan. The usage and revenue trends are folded
into the same aggregation as conditional means: their windows lie inside the
stats window, so the reference's second scan, second shuffle and join on the
key disappear while the result rows stay identical.

``profile="full"`` is the SQL-file variant of each query; ``profile="core"``
is the reduced variant used by the extraction script and the training table.
"""

from __future__ import annotations

import datetime as dt
import functools
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import dates
from ..functions import exprs as X

FULL = "full"
CORE = "core"


#: Words of 64 days that cover the usage window (a month has at most 31 days).
DAY_WORDS = -(-(31 * C.USAGE_MONTHS + 1) // 64)


def _check(profile: str) -> None:
    if profile not in (FULL, CORE):
        raise ValueError(f"profile must be 'full' or 'core', got {profile!r}")


def _window(df: DataFrame, ts: str, lower, as_of) -> DataFrame:
    """``ts >= lower AND ts < as_of`` with both bounds literal-foldable."""
    return df.where(dates.in_window(F.col(ts), lower, dates.as_of_literal(as_of)))


# ---------------------------------------------------------------------------
# Q1 customer base
# ---------------------------------------------------------------------------

def customer_base(customers: DataFrame, as_of, profile: str = FULL) -> DataFrame:
    """Customers who signed up in the two years before ``as_of`` with tenure,
    churn label and (full profile) plan, lifecycle stage and the test-account
    filter."""
    _check(profile)
    clock = dates.as_of_literal(as_of)
    df = _window(customers, "signup_date", dates.years_before(as_of, C.CUSTOMER_BASE_YEARS), as_of)
    if profile == FULL:
        df = df.where(F.col("is_test_account") == 0)
    tenure = dates.day_diff(F.col("signup_date"), clock)
    cols = [
        F.col("customer_id"), F.col("signup_date"), F.col("account_status"),
        F.col("country"), F.col("company_size"), F.col("industry"),
    ]
    if profile == FULL:
        cols.append(F.col("plan_type"))
    cols += [tenure.alias("tenure_days"), X.churn_label(F.col("account_status")).alias("churned")]
    if profile == FULL:
        cols.append(X.lifecycle_stage(tenure).alias("customer_lifecycle_stage"))
    return df.select(cols)


# ---------------------------------------------------------------------------
# Q2 usage
# ---------------------------------------------------------------------------

def _distinct(col, approx_rsd: float | None):
    """Exact distinct count, or HyperLogLog++ with relative error
    ``approx_rsd``: the approximate form needs no expand-and-reshuffle of the
    rows, which matters when three distinct counts share one aggregation."""
    c = F.col(col) if isinstance(col, str) else col
    return F.approx_count_distinct(c, approx_rsd) if approx_rsd else F.countDistinct(c)


def usage_metrics(activity: DataFrame, as_of, profile: str = FULL, approx_rsd: float | None = None) -> DataFrame:
    """Six-month product usage per customer; the full profile adds API calls
    and the one-month versus previous-three-months session-length trend.

    Distinct counts are exact unless ``approx_rsd`` (e.g. 0.01) is given."""
    _check(profile)
    clock = dates.as_of_literal(as_of)
    login = F.col("login_date")
    dur = F.col("session_duration_minutes")
    df = _window(activity, "login_date", dates.months_before(as_of, C.USAGE_MONTHS), as_of)
    aggs = [
        _distinct("session_id", approx_rsd).alias("total_sessions"),
        X.exact_mean(dur).alias("avg_session_duration"),
        F.max(login).alias("last_login_date"),
        _distinct("feature_id", approx_rsd).alias("unique_features_used"),
        X.count_when(F.col("event_type") == C.EVENT_FEATURE_ADOPTION).alias("feature_adoptions"),
    ]
    if profile == FULL:
        recent_lo = dates.months_before(as_of, C.USAGE_RECENT_MONTHS)
        # the previous window is cut by the trend pre-filter as well: take the later bound
        previous_lo = F.greatest(
            dates.nested_months_before(as_of, C.USAGE_RECENT_MONTHS, C.USAGE_PREVIOUS_MONTHS),
            dates.months_before(as_of, C.USAGE_TREND_PREFILTER_MONTHS),
        )
        aggs += [
            F.sum("api_calls").cast("long").alias("total_api_calls"),
            X.mean_when(login >= recent_lo, dur).alias("recent_avg_session"),
            X.mean_when((login >= previous_lo) & (login < recent_lo), dur).alias("previous_avg_session"),
        ]
    # a day is a bit: the window's days fill three or four words, an exact count without expanding rows
    first = dates.to_day(dates.months_before(as_of, C.USAGE_MONTHS))
    at = F.date_diff(dates.to_day(login), first)
    words = [F.bit_or(F.when(F.floor(at / 64) == w, F.call_function("shiftleft", F.lit(1).cast("long"), at % 64))).alias(f"_day_{w}")
             for w in range(DAY_WORDS)]
    active = sum((F.bit_count(F.coalesce(F.col(f"_day_{w}"), F.lit(0).cast("long"))) for w in range(DAY_WORDS)), F.lit(0))
    g = df.groupBy("customer_id").agg(*aggs, *words).withColumn("active_days", active.cast("long"))
    return usage_columns(g, clock, profile)


def usage_columns(g: DataFrame, clock, profile: str) -> DataFrame:
    """Result columns of Q2 from one row of aggregates per customer."""
    out = [
        F.col("customer_id"),
        X.coalesce_zero(F.col("total_sessions")).alias("total_sessions"),
        X.coalesce_zero(F.col("active_days")).alias("active_days"),
        F.coalesce(F.col("avg_session_duration"), F.lit(0.0)).alias("avg_session_duration"),
        dates.day_diff(F.col("last_login_date"), clock).alias("days_since_last_login"),
        X.coalesce_zero(F.col("unique_features_used")).alias("unique_features_used"),
        X.coalesce_zero(F.col("feature_adoptions")).alias("feature_adoptions"),
    ]
    if profile == FULL:
        out.append(X.coalesce_zero(F.col("total_api_calls")).alias("total_api_calls"))
    out.append(X.safe_ratio(F.col("total_sessions"), F.col("active_days")).alias("sessions_per_active_day"))
    if profile == FULL:
        out.append(X.relative_change(F.col("recent_avg_session"), F.col("previous_avg_session"))
                   .alias("session_duration_trend"))
    return g.select(out)


def activity_rollup(activity: DataFrame, as_of) -> DataFrame:
    """The condensed roll-up - days since login, features used, mean
    session time over six months."""
    clock = dates.as_of_literal(as_of)
    df = _window(activity, "login_date", dates.months_before(as_of, C.USAGE_MONTHS), as_of)
    return df.groupBy("customer_id").agg(
        dates.day_diff(F.max("login_date"), clock).alias("days_since_login"),
        F.countDistinct("feature_id").alias("features_used"),
        X.exact_mean(F.col("session_duration_minutes")).alias("avg_session_time"),
    )


# ---------------------------------------------------------------------------
# Q3 financial
# ---------------------------------------------------------------------------

def financial_metrics(invoices: DataFrame, as_of, profile: str = FULL) -> DataFrame:
    """Twelve-month revenue and payment behaviour; the full profile adds the
    three-month versus previous-six-months revenue trend and days since the
    last payment, the core profile keeps ``last_invoice_date``."""
    _check(profile)
    clock = dates.as_of_literal(as_of)
    day = F.col("invoice_date")
    amount = F.col("amount")
    status = F.col("payment_status")
    df = _window(invoices, "invoice_date", dates.months_before(as_of, C.FINANCIAL_MONTHS), as_of)
    aggs = [
        F.sum(amount).alias("_revenue"),
        X.exact_mean(amount).alias("avg_monthly_revenue"),
        F.count(F.lit(1)).alias("total_invoices"),
        F.max(day).alias("last_invoice_date"),
        X.count_when(status == C.PAYMENT_LATE).alias("late_payments"),
        X.count_when(status == C.PAYMENT_FAILED).alias("failed_payments"),
        X.count_when(status == C.PAYMENT_PAID).alias("successful_payments"),
    ]
    if profile == FULL:
        recent_lo = dates.months_before(as_of, C.REVENUE_RECENT_MONTHS)
        previous_lo = F.greatest(
            dates.nested_months_before(as_of, C.REVENUE_RECENT_MONTHS, C.REVENUE_PREVIOUS_MONTHS),
            dates.months_before(as_of, C.REVENUE_TREND_PREFILTER_MONTHS),
        )
        aggs += [
            X.mean_when(day >= recent_lo, amount).alias("recent_mrr"),
            X.mean_when((day >= previous_lo) & (day < recent_lo), amount).alias("previous_mrr"),
        ]
    return financial_columns(df.groupBy("customer_id").agg(*aggs), clock, profile)


def financial_columns(g: DataFrame, clock, profile: str) -> DataFrame:
    """Result columns of Q3 from one row of aggregates per customer."""
    revenue = F.coalesce(F.col("_revenue").cast("double"), F.lit(0.0)).alias("total_revenue")
    avg_rev = F.coalesce(F.col("avg_monthly_revenue"), F.lit(0.0)).alias("avg_monthly_revenue")
    success = X.safe_ratio(F.col("successful_payments"), F.col("total_invoices")).alias("payment_success_rate")
    if profile == CORE:
        return g.select("customer_id", revenue, avg_rev, "total_invoices", "late_payments",
                        "failed_payments", "last_invoice_date", success)
    return g.select(
        "customer_id", revenue, avg_rev, "total_invoices", "late_payments", "failed_payments", success,
        X.relative_change(F.col("recent_mrr"), F.col("previous_mrr")).alias("revenue_trend"),
        dates.day_diff(F.col("last_invoice_date"), clock).alias("days_since_last_payment"),
    )


# ---------------------------------------------------------------------------
# Q4 support
# ---------------------------------------------------------------------------

def support_metrics(tickets: DataFrame, as_of, profile: str = FULL) -> DataFrame:
    """Six-month ticket counts by priority and status, mean resolution hours
    (hour boundaries, unresolved tickets skipped), satisfaction and resolution
    rate."""
    _check(profile)
    created = F.col("created_date")
    prio = F.col("priority")
    status = F.col("status")
    df = _window(tickets, "created_date", dates.months_before(as_of, C.SUPPORT_MONTHS), as_of)
    n = F.count(F.lit(1))
    hours = X.exact_mean(dates.hour_diff(created, F.col("resolved_date")))
    if profile == CORE:
        return df.groupBy("customer_id").agg(
            n.alias("total_tickets"),
            hours.alias("avg_resolution_hours"),
            X.count_when(prio == C.PRIORITY_HIGH).alias("high_priority_tickets"),
            X.count_when(status == C.TICKET_ESCALATED).alias("escalated_tickets"),
            F.max(created).alias("last_ticket_date"),
        )
    return df.groupBy("customer_id").agg(
        n.alias("total_tickets"),
        hours.alias("avg_resolution_hours"),
        X.count_when(prio == C.PRIORITY_HIGH).alias("high_priority_tickets"),
        X.count_when(prio == C.PRIORITY_CRITICAL).alias("critical_tickets"),
        X.count_when(status == C.TICKET_ESCALATED).alias("escalated_tickets"),
        X.count_when(status == C.TICKET_REOPENED).alias("reopened_tickets"),
        F.max(created).alias("last_ticket_date"),
        X.exact_mean(F.col("satisfaction_score")).alias("avg_satisfaction_score"),
        X.safe_ratio(X.count_when(status == C.TICKET_RESOLVED), n).alias("resolution_rate"),
    )


# ---------------------------------------------------------------------------
# Q5 marketing
# ---------------------------------------------------------------------------

def marketing_metrics(engagement: DataFrame, as_of, profile: str = FULL) -> DataFrame:
    """Six-month email engagement: counts, open rate, click-through rate
    (clicks over opens, so it can exceed 1), NPS and campaigns."""
    _check(profile)
    df = _window(engagement, "sent_date", dates.months_before(as_of, C.MARKETING_MONTHS), as_of)
    n = F.count(F.lit(1))
    opened = X.count_when(F.col("opened") == 1)
    clicked = X.count_when(F.col("clicked") == 1)
    aggs = [
        n.alias("emails_sent"),
        opened.alias("emails_opened"),
        clicked.alias("emails_clicked"),
    ]
    if profile == FULL:
        aggs.append(X.count_when(F.col("unsubscribed") == 1).alias("unsubscribes"))
    aggs.append(X.safe_ratio(opened, n).alias("open_rate"))
    if profile == FULL:
        aggs.append(X.safe_ratio(clicked, opened).alias("click_through_rate"))
    aggs.append(X.exact_mean(F.col("nps_score")).alias("avg_nps_score"))
    if profile == FULL:
        aggs.append(F.countDistinct("campaign_id").alias("campaigns_engaged"))
    return df.groupBy("customer_id").agg(*aggs)


# ---------------------------------------------------------------------------
# Q6 merged feature table
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Clocks:
    """Per-source clock; normally all equal."""

    customers: object
    activity: object
    invoices: object
    tickets: object
    marketing: object

    @classmethod
    def single(cls, as_of) -> "Clocks":
        return cls(as_of, as_of, as_of, as_of, as_of)


def merge_feature_sets(base: DataFrame, *sets: DataFrame, key: str = "customer_id") -> DataFrame:
    """Left-join each feature set onto the base. Every right side is
    unique per key (it is a group-by output), so base rows are preserved; the
    aggregations already hash-partitioned the right sides on the key, so the
    joins reuse that partitioning."""
    return functools.reduce(lambda acc, s: acc.join(s, key, "left"), sets, base)


def build_features(tables: dict[str, DataFrame], as_of, profile: str = CORE,
                   recency_fill: int | None = None) -> DataFrame:
    """Q6: customer base left-joined with the four metric sets, NULL numeric
    features zero-filled (dates and strings stay NULL).

    Zero-filling ``days_since_last_login`` reads "never logged in" as "logged
    in today", as the reference does. ``recency_fill`` replaces that NULL with
    a number of days instead (for example the window length, 183)."""
    clocks = as_of if isinstance(as_of, Clocks) else Clocks.single(as_of)
    base = customer_base(tables["customers"], clocks.customers, profile)
    merged = merge_feature_sets(
        base,
        usage_metrics(tables["user_activity"], clocks.activity, profile),
        financial_metrics(tables["invoices"], clocks.invoices, profile),
        support_metrics(tables["support_tickets"], clocks.tickets, profile),
        marketing_metrics(tables["marketing_engagement"], clocks.marketing, profile),
    )
    if recency_fill is not None:
        merged = merged.withColumn("days_since_last_login",
                                   F.coalesce(F.col("days_since_last_login"), F.lit(int(recency_fill))))
    return X.fill_numeric_nulls(merged)


def as_datetime(value) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(str(value))
