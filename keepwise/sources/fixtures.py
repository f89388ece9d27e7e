"""Adapters from the driver's TPC-H-style tables to the business tables.

The reference ships no data; ``FIXTURES.md`` fixes how each business table is
derived from the driver's Parquet tables. Every adapter is a projection,
joined at most to a dimension or a per-customer key set, so Catalyst prunes
columns and pushes date filters through the renamed columns into the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import dates, exprs

# Fixed clocks of the fixture data.
AS_OF_ORDERS = dt.datetime(2001, 2, 1)
AS_OF_EVENTS = dt.datetime(2024, 2, 15)
STATUS_HORIZON_MONTHS = 6

# Fixed values of the adapter (FIXTURES.md).
SIGNUP_ORIGIN = "1998-02-01 00:00:00"
SIGNUP_STRIDE_DAYS = 37
SIGNUP_SPAN_DAYS = 1096
SMALL_ACCTBAL = 2500
MEDIUM_ACCTBAL = 6500
PLAN_TYPES = ("Basic", "Pro", "Enterprise")
TEST_ACCOUNT_MODULUS = 50
TICKET_CREATED_STRIDE_MINUTES = 17
TICKET_RESOLUTION_MINUTES_PER_UNIT = 37
NPS_MODULUS = 11
CAMPAIGN_MODULUS = 7
PROBABILITY_MODULUS = 10001
PROBABILITY_SCALE = 10000
CREATED_STRIDE = 7

# Schemas of the driver's tables as written: declared, so a read needs no
# footer-reading job to infer them.
RAW_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = RAW_SCHEMAS.get(name)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def _json_k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def customers(spark: SparkSession, sf_dir: str, as_of=AS_OF_ORDERS,
              horizon_months: int = STATUS_HORIZON_MONTHS) -> DataFrame:
    """customers <- customer, nation, orders.

    ``account_status`` is 'Active' iff the customer orders in the
    ``horizon_months`` after ``as_of`` (a label from the future). The active
    keys are a distinct aggregate over a pushed-down date range; it shrinks to
    one row per customer before the shuffle.
    """
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey"), F.col("n_name").alias("country"))
    clock = dates.as_of_literal(as_of)
    active = (
        read_table(spark, sf_dir, "orders")
        .where((F.col("o_orderdate") >= clock)
               & (F.col("o_orderdate") < dates.shift(clock, "MONTH", horizon_months)))
        .select(F.col("o_custkey").alias("c_custkey"))
        .distinct()
        .withColumn("_active", F.lit(True))
    )
    plan = F.col("c_custkey") % 3
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "left")
        .join(active, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.timestamp_add(
                "DAY",
                ((F.col("c_custkey") * SIGNUP_STRIDE_DAYS) % SIGNUP_SPAN_DAYS).cast("int"),
                F.lit(SIGNUP_ORIGIN).cast("timestamp_ntz"),
            ).alias("signup_date"),
            F.when(F.col("_active").isNotNull(), F.lit(C.STATUS_ACTIVE))
            .otherwise(F.lit(C.STATUS_CHURNED)).alias("account_status"),
            F.col("country"),
            F.when(F.col("c_acctbal") < SMALL_ACCTBAL, "Small")
            .when(F.col("c_acctbal") < MEDIUM_ACCTBAL, "Medium")
            .otherwise("Large").alias("company_size"),
            F.col("c_mktsegment").alias("industry"),
            F.when(plan == 0, PLAN_TYPES[0]).when(plan == 1, PLAN_TYPES[1])
            .otherwise(PLAN_TYPES[2]).alias("plan_type"),
            exprs.flag(F.col("c_custkey") % TEST_ACCOUNT_MODULUS == 0).alias("is_test_account"),
            F.col("c_name").alias("company_name"),
            F.concat(F.lit("AM-"), F.col("c_nationkey").cast("string")).alias("account_manager"),
        )
    )


def user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_activity <- events (one row per event).

    ``props`` is parsed once into ``k`` in an inner projection; Catalyst does
    not collapse a costly expression into two uses, so the JSON is read once
    per row."""
    e = read_table(spark, sf_dir, "events").select(
        "user_id", "ts", "value", "event_type", _json_k(F.col("props")).alias("_k"))
    return e.select(
        F.col("user_id").alias("customer_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"),
                 F.date_format("ts", "yyyyMMddHH")).alias("session_id"),
        F.col("ts").alias("login_date"),
        F.col("value").cast("decimal(10,2)").alias("session_duration_minutes"),
        F.col("_k").alias("feature_id"),
        F.when(F.col("event_type") == "signup", F.lit(C.EVENT_FEATURE_ADOPTION))
        .otherwise(F.col("event_type")).alias("event_type"),
        F.col("_k").alias("api_calls"),
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """invoices <- orders (one invoice per order)."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        F.col("o_orderdate").alias("invoice_date"),
        F.when(F.col("o_orderstatus") == "F", F.lit(C.PAYMENT_PAID))
        .when(F.col("o_orderstatus") == "O", F.lit(C.PAYMENT_LATE))
        .when(F.col("o_orderstatus") == "P", F.lit(C.PAYMENT_FAILED))
        .alias("payment_status"),
    )


def support_tickets(spark: SparkSession, sf_dir: str, since=None, until=None) -> DataFrame:
    """support_tickets <- lineitem joined to orders on the order key.

    ``created_date`` is shifted from ``l_shipdate`` by at most 7 x 17 minutes,
    so a filter on it cannot reach the scan. When the caller knows its window
    it passes ``since``/``until`` and the adapter adds a one-day-wider filter
    on the bare ``l_shipdate``; rows are still filtered exactly downstream.
    """
    li = read_table(spark, sf_dir, "lineitem")
    if since is not None:
        li = li.where(F.col("l_shipdate") >= dates.shift(dates.as_of_literal(since), "DAY", -1))
    if until is not None:
        li = li.where(F.col("l_shipdate") < dates.as_of_literal(until))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    created = F.timestamp_add(
        "MINUTE", (F.col("l_linenumber") * TICKET_CREATED_STRIDE_MINUTES).cast("long"), F.col("l_shipdate"))
    resolved = F.timestamp_add(
        "MINUTE", (F.col("l_quantity") * TICKET_RESOLUTION_MINUTES_PER_UNIT).cast("long"), created)
    status = (
        F.when(F.col("l_returnflag") == "A", F.lit(C.TICKET_RESOLVED))
        .when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), F.lit(C.TICKET_ESCALATED))
        .when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.lit(C.TICKET_REOPENED))
        .otherwise(F.lit("Open"))
    )
    prio = F.col("o_orderpriority")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.col("o_custkey").alias("customer_id"),
        created.alias("created_date"),
        F.when(F.col("l_returnflag") != "N", resolved).alias("resolved_date"),
        F.when(prio == "1-URGENT", F.lit(C.PRIORITY_CRITICAL))
        .when(prio == "2-HIGH", F.lit(C.PRIORITY_HIGH))
        .when(prio == "3-MEDIUM", F.lit("Medium"))
        .otherwise(F.lit("Low")).alias("priority"),
        status.alias("status"),
        F.when(F.col("l_returnflag") != "N", (F.col("l_linenumber") % 5) + 1)
        .cast("int").alias("satisfaction_score"),
    )


def marketing_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """marketing_engagement <- events (one email per event)."""
    e = read_table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_type", _json_k(F.col("props")).alias("_k"))
    k = F.col("_k")
    et = F.col("event_type")
    return e.select(
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("sent_date"),
        exprs.flag(et.isin("view", "click")).alias("opened"),
        exprs.flag(et == "click").alias("clicked"),
        exprs.flag(et == "error").alias("unsubscribed"),
        (k % NPS_MODULUS).alias("nps_score"),
        (k % CAMPAIGN_MODULUS).alias("campaign_id"),
    )


def fixture_probability(key: Column, salt: str = ":p") -> Column:
    """Deterministic score in [0, 1] with four decimals, as a double."""
    h = exprs.hash32(F.concat(key.cast("string"), F.lit(salt)))
    return (h % PROBABILITY_MODULUS).cast("double") / F.lit(float(PROBABILITY_SCALE))


def churn_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """churn_predictions <- orders (one score per order, also after the clock;
    several of one customer and day differ in their minute of insert)."""
    o = read_table(spark, sf_dir, "orders")
    p = fixture_probability(F.col("o_orderkey"))
    return o.select(
        F.col("o_orderkey").cast("string").alias("prediction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("prediction_date"),
        p.cast("decimal(5,4)").alias("churn_probability"),
        exprs.risk_tier(p).alias("risk_tier"),
        F.lit(C.DEFAULT_MODEL_VERSION).alias("model_version"),
        F.timestamp_add("MINUTE", (F.col("o_orderkey") * CREATED_STRIDE) % 1440, F.col("o_orderdate")).alias("created_at"),
    )


def scored_labels(spark: SparkSession, sf_dir: str, as_of=AS_OF_ORDERS) -> DataFrame:
    """(customer_id, label, probability) for evaluation: the customers with a
    fixture prediction, their status label and a score of 32 binary digits."""
    from ..operators.scores import latest_prediction

    lp = latest_prediction(churn_predictions(spark, sf_dir), as_of=as_of)
    cust = customers(spark, sf_dir, as_of).select("customer_id", "account_status")
    return lp.join(cust, "customer_id", "inner").select(
        "customer_id",
        exprs.churn_label(F.col("account_status")).alias("label"),
        (exprs.hash32(F.concat(F.col("customer_id").cast("string"), F.lit(":e"))).cast("double") / F.lit(2.0**32))
        .alias("probability"),
    )


def fixture_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All business tables from one driver folder."""
    return {
        "customers": customers(spark, sf_dir),
        "user_activity": user_activity(spark, sf_dir),
        "invoices": invoices(spark, sf_dir),
        "support_tickets": support_tickets(spark, sf_dir),
        "marketing_engagement": marketing_engagement(spark, sf_dir),
        "churn_predictions": churn_predictions(spark, sf_dir),
    }
