"""Business reports over features and predictions (Q8, R1 .. R5, A11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import dates
from ..functions import exprs as X
from .ordering import global_row_number
from .scores import latest_prediction

REPORT_COLUMNS = (
    "customer_id", "company_name", "account_manager", "churn_probability", "risk_tier",
    "monthly_value", "tenure_days", "days_since_last_login", "unique_features_used",
    "recent_support_tickets",
)


def high_risk_report(customers: DataFrame, predictions: DataFrame, usage: DataFrame,
                     financial: DataFrame, support: DataFrame, as_of) -> DataFrame:
    """Q8: latest prediction per customer as of the clock (later ones are not
    seen), kept when it is 'High Risk' and the customer is 'Active', with
    monthly value, tenure, recency, features used and recent tickets; ordered
    by probability then value (both descending). Lazy: ``rank_report`` numbers
    the rows when the report is written.

    ``usage``/``financial``/``support`` are the outputs of Q2/Q3/Q4: the
    reference reads ``avg_monthly_revenue`` and ``tenure_days`` off
    ``customers``, where they do not exist. The tier filter runs after the
    latest row is chosen (filtering first would pick an older High row).
    """
    clock = dates.as_of_literal(as_of)
    lp = (latest_prediction(predictions, as_of=as_of)
          .where(F.col("risk_tier") == C.HIGH_RISK)
          .select("customer_id", F.col("churn_probability").cast("double").alias("churn_probability"),
                  "risk_tier"))
    c = (customers.where(F.col("account_status") == C.STATUS_ACTIVE)
         .select("customer_id", "company_name", "account_manager",
                 dates.day_diff(F.col("signup_date"), clock).alias("tenure_days")))
    report = (
        c.join(lp, "customer_id", "inner")
        .join(financial.select("customer_id", F.col("avg_monthly_revenue").alias("monthly_value")),
              "customer_id", "left")
        .join(usage.select("customer_id", "days_since_last_login", "unique_features_used"),
              "customer_id", "left")
        .join(support.select("customer_id", F.col("total_tickets").alias("recent_support_tickets")),
              "customer_id", "left")
        .select(*REPORT_COLUMNS)
    )
    return report.orderBy(*report_order())


def rank_report(report: DataFrame, rank_col: str = "report_rank") -> DataFrame:
    """The report with each row's position (a distributed sort; runs jobs)."""
    return global_row_number(report, report_order(), rank_col)


def report_order():
    return [F.col("churn_probability").desc(), F.col("monthly_value").desc_nulls_last(),
            F.col("customer_id").asc()]


def extraction_summary(features: DataFrame, label: str = "churned") -> DataFrame:
    """Customers, churned customers, churn rate in percent and the
    number of columns of the feature table, in one global aggregation."""
    return features.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum(F.col(label)).cast("long").alias("churned_customers"),
        (X.exact_mean(F.col(label)) * F.lit(100.0)).alias("churn_rate_pct"),
        F.lit(len(features.columns)).cast("long").alias("total_features"),
    )


def attach_scalar(df: DataFrame, scalar: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row.

    The aggregate becomes one uncorrelated scalar subquery (a struct of its
    columns): Spark runs it once and injects the value into the projection,
    so there is no join at all, let alone a cartesian product."""
    cols = scalar.columns
    packed = scalar.select(F.struct(*[F.col(c) for c in cols]).alias("_kw_scalar")).scalar()
    out = df.withColumn("_kw_scalar", packed)
    return out.select(*[F.col(c) for c in df.columns],
                      *[F.col(f"_kw_scalar.{c}").alias(c) for c in cols])


def features_used(activity: DataFrame, as_of, months: int = C.USAGE_MONTHS) -> DataFrame:
    """Distinct (customer_id, feature_id) of the window: one scan, whose
    exchange serves both the counts per customer and the number available."""
    return activity.where(dates.in_window(F.col("login_date"), dates.months_before(as_of, months),
                                          dates.as_of_literal(as_of))).select("customer_id", "feature_id").distinct()


def features_available(used: DataFrame) -> DataFrame:
    """One row: features used by anyone. Counted from customers per feature:
    a plain distinct of the feature would be pushed below the distinct pairs
    and scan the activity again instead of reading their exchange."""
    users = used.groupBy("feature_id").agg(F.count(F.lit(1)).alias("users"))
    return users.where("users > 0").agg(F.count("feature_id").alias("features_available"))


def feature_adoption_share(activity: DataFrame, as_of, months: int = C.USAGE_MONTHS) -> DataFrame:
    """Features used by a customer over features used by anyone in the
    same window."""
    used = features_used(activity, as_of, months)
    per_customer = used.groupBy("customer_id").agg(F.count("feature_id").alias("unique_features_used"))
    return attach_scalar(per_customer, features_available(used)).select(
        "customer_id", "unique_features_used", "features_available",
        X.safe_ratio(F.col("unique_features_used"), F.col("features_available")).alias("adoption_share"),
    )


def indicator_lift(features: DataFrame, features_available: DataFrame, thresholds=None,
                   label: str = "churned") -> DataFrame:
    """Churn rate among customers flagged by an indicator over the churn
    rate of the others, one row per indicator.

    Indicators: inactive for more than N days, more than N tickets a month,
    less than a share of the available features, at least N late payments.
    ``lift`` is NULL when either group is empty or the other group never
    churned. One global aggregation of conditional counts, then ``stack``.
    """
    t = thresholds or C.LiftThresholds()
    df = attach_scalar(features, features_available)
    flags = {
        "inactive": F.col("days_since_last_login") > F.lit(float(t.inactive_days)),
        "support_tickets": (F.col("total_tickets").cast("double") / F.lit(float(t.ticket_window_months)))
        > F.lit(float(t.tickets_per_month)),
        "low_adoption": X.safe_ratio(F.col("unique_features_used"), F.col("features_available"))
        < F.lit(float(t.feature_share)),
        "late_payment": F.col("late_payments") >= F.lit(int(t.late_payments)),
    }
    y = F.col(label) == 1
    aggs = []
    for name, cond in flags.items():
        c = F.coalesce(cond, F.lit(False))
        aggs += [X.count_when(c).alias(f"{name}__n1"), X.count_when(c & y).alias(f"{name}__c1"),
                 X.count_when(~c).alias(f"{name}__n0"), X.count_when(~c & y).alias(f"{name}__c0")]
    counts = df.agg(*aggs)
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("indicator"), F.col(f"{name}__n1").alias("n1"),
                 F.col(f"{name}__c1").alias("c1"), F.col(f"{name}__n0").alias("n0"),
                 F.col(f"{name}__c0").alias("c0"))
        for name in flags])).alias("r")).select("r.*")
    rate1 = F.when(F.col("n1") > 0, F.col("c1").cast("double") / F.col("n1").cast("double"))
    rate0 = F.when(F.col("n0") > 0, F.col("c0").cast("double") / F.col("n0").cast("double"))
    return stacked.select(
        "indicator",
        F.col("n1").alias("flagged"),
        rate1.alias("rate_flagged"),
        rate0.alias("rate_other"),
        F.when(rate0 > 0, rate1 / rate0).alias("lift"),
    )


def tier_segments(scored: DataFrame, value_col: str = "value") -> DataFrame:
    """R2: customers, value and mean probability per risk tier.

    Value is summed as a decimal (cents), so the total does not depend on the
    order in which partitions are combined."""
    return scored.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col(value_col).cast("decimal(18,2)")).cast("double").alias("total_value"),
        X.exact_mean(F.col("churn_probability").cast("decimal(5,4)")).alias("avg_probability"),
    )


def recommended_action(scored: DataFrame) -> DataFrame:
    """The README's action per tier, as a CASE over the tier column (the
    three-row rule table is a fixed constant, never data-sized)."""
    action = F.lit(None).cast("string")
    detail = F.lit(None).cast("string")
    for tier, act, text in reversed(C.TIER_ACTIONS):
        action = F.when(F.col("risk_tier") == tier, F.lit(act)).otherwise(action)
        detail = F.when(F.col("risk_tier") == tier, F.lit(text)).otherwise(detail)
    return scored.withColumn("action", action).withColumn("action_detail", detail)


def revenue_at_risk(scored: DataFrame, value_col: str = "value", outcome_col: str = "account_status",
                    saved_value: str = C.STATUS_ACTIVE) -> DataFrame:
    """One row - high-risk customers, their value, how many were saved
    (still active later), save rate and value protected (= value at risk times
    save rate)."""
    high = F.col("risk_tier") == C.HIGH_RISK
    saved = high & (F.col(outcome_col) == saved_value)
    value = F.col(value_col).cast("decimal(18,2)")
    agg = scored.agg(
        X.count_when(high).alias("high_risk_customers"),
        F.coalesce(F.sum(F.when(high, value)), F.lit(0)).cast("double").alias("revenue_at_risk"),
        X.count_when(saved).alias("saved_customers"),
    )
    rate = X.safe_ratio(F.col("saved_customers"), F.col("high_risk_customers"))
    return agg.select("high_risk_customers", "revenue_at_risk", "saved_customers",
                      rate.alias("save_rate"),
                      (F.col("revenue_at_risk") * rate).alias("net_revenue_protected"))
