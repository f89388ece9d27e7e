"""Registered queries on states that are carried from run to run: rolling
windows (Q2, Q3, R6) and the maintained latest table (W1, Q8), each with the
twin of the full recomputation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..ml import train as ML
from ..operators import features as FT
from ..operators import reports as R
from ..operators import rolling as RW
from ..operators import scores as S
from ..sources import checked as CK
from ..sources import fixtures as fx
from ..sources import latest as L
from ..sources import layout
from ..sources import tables as TB
from ..streaming.keyed import score_stream_daily
from . import oracle as O
from .analytics import _MERGED_WITH, AS_OF_E, AS_OF_O, _merged, _train_model, register
from .oracle_tables import AS_OF_ORDERS_SQL as OR
from .oracle_tables import with_tables
from .queries import FIXTURE_CLOCKS, fixture_feature_tables, tickets_for_window

DAY = dt.timedelta(days=1)
#: A day whose rows arrive in two portions, and a clock half a year on, when the first days have left the window.
LATE_DAY = dt.datetime(2024, 1, 28)
LATER_CLOCK = dt.datetime(2024, 7, 20)


def _activity_state(spark, d, last):
    """State of activity up to ``last``: the past, a day with half of its rows,
    the same day once more when all have come, the next day, the rest."""
    path = TB.scratch_path(spark, "rolling")
    activity = fx.user_activity(spark, d)
    RW.advance(path, dt.datetime(2023, 8, 1), LATE_DAY, activity)
    RW.advance(path, LATE_DAY, LATE_DAY + DAY, activity.where(F.pmod(F.col("customer_id"), F.lit(2)) == 0))
    RW.advance(path, LATE_DAY, LATE_DAY + DAY, activity)
    RW.advance(path, LATE_DAY + DAY, LATE_DAY + 2 * DAY, activity)
    RW.advance(path, LATE_DAY + 2 * DAY, last, activity)
    return path


@register("rolling_usage_metrics", O.q_usage("full"))
def rolling_usage_metrics(spark, d):
    """Usage at the clock from daily states, raw rows read one day at a time."""
    return RW.rolling_usage(spark, _activity_state(spark, d, AS_OF_E), AS_OF_E)


@register("rolling_activity_rollup", with_tables("user_activity") + f"""SELECT customer_id,
    CAST(date_diff('day', MAX(login_date), TIMESTAMP '{LATER_CLOCK}') AS INTEGER) AS days_since_login,
    COUNT(DISTINCT feature_id) AS features_used, {O.mean('session_duration_minutes')} AS avg_session_time
    FROM user_activity WHERE login_date >= TIMESTAMP '{LATER_CLOCK}' - INTERVAL 6 MONTH AND login_date < TIMESTAMP '{LATER_CLOCK}'
    GROUP BY customer_id""")
def rolling_activity_rollup(spark, d):
    """The roll-up half a year on: days that have left the window no longer count."""
    return RW.rolling_rollup(spark, _activity_state(spark, d, LATER_CLOCK), LATER_CLOCK)


@register("rolling_financial_metrics", O.q_financial("full"))
def rolling_financial_metrics(spark, d):
    """Revenue at the clock from daily states that begin before the window."""
    path = TB.scratch_path(spark, "rolling")
    invoices = fx.invoices(spark, d)
    first = AS_OF_O - dt.timedelta(days=400)
    RW.advance(path, first, AS_OF_O - 2 * DAY, invoices=invoices)
    for day in (AS_OF_O - 2 * DAY, AS_OF_O - DAY):
        RW.advance(path, day, day + DAY, invoices=invoices)
    return RW.rolling_financial(spark, path, AS_OF_O)


#: The store holds one folder per day and run: the fixture's predictions are dated to their quarter, so runs stay few
#: (insert times keep the order within a quarter).
_QUARTERLY = """quarterly AS (SELECT * REPLACE (CAST(date_trunc('quarter', prediction_date) AS DATE) AS prediction_date)
    FROM churn_predictions)"""
_NEWEST = O.NEWEST_CTE.replace("FROM churn_predictions p", "FROM quarterly p")
#: Runs by the day they score; the third comes last but one, the second twice.
_RUN_ENDS = (dt.date(1997, 1, 1), dt.date(1998, 7, 1), dt.date(2000, 1, 1), dt.date(2001, 1, 1))
_RUN_ORDER = (0, 1, 3, 4, 2, 1)


def _latest_table(spark, d):
    """Store and latest table after five runs of the fixture's predictions, one
    of them late and one repeated: its first content had other probabilities,
    later insert times and rows of other customers."""
    base = TB.scratch_path(spark, "latest")
    store, path = f"{base}/store", f"{base}/table"
    preds = fx.churn_predictions(spark, d).withColumn("prediction_date", F.trunc("prediction_date", "quarter"))
    day = F.col("prediction_date")
    number = sum((F.when(day >= F.lit(end), 1).otherwise(0) for end in _RUN_ENDS), F.lit(0))
    seen = set()
    for run in _RUN_ORDER:
        rows = preds.where(number == run)
        if run == 1 and run not in seen:
            moved = rows.withColumn("customer_id", F.col("customer_id") + 1).withColumn("prediction_id", F.concat("prediction_id", F.lit("x")))
            rows = rows.unionByName(moved).withColumn("churn_probability", (1 - F.col("churn_probability")).cast("decimal(5,4)")).withColumn(
                "created_at", F.timestamp_add("DAY", F.lit(1), F.col("created_at")))
        seen.add(run)
        TB.append_predictions(rows, store, run_id=f"run-{run}")
        L.update_latest(spark, path, store, f"run-{run}")
    return store, path


@register("maintained_latest", with_tables("churn_predictions", extra=[_QUARTERLY, _NEWEST]) + """SELECT customer_id, prediction_id, prediction_date,
    CAST(churn_probability AS DOUBLE) AS churn_probability, risk_tier FROM newest""")
def maintained_latest(spark, d):
    """The latest prediction as of the clock from the maintained table."""
    store, path = _latest_table(spark, d)
    return L.read_latest(spark, path, AS_OF_O, store).select(
        "customer_id", "prediction_id", "prediction_date", F.col("churn_probability").cast("double").alias("churn_probability"),
        "risk_tier")


@register("maintained_report", O.q_high_risk_report().replace(O.NEWEST_CTE, f"{_QUARTERLY},\n{_NEWEST}"))
def maintained_report(spark, d):
    """The high-risk report read from the maintained table."""
    store, path = _latest_table(spark, d)
    return R.rank_report(R.high_risk_report(
        fx.customers(spark, d), L.read_latest(spark, path, AS_OF_O, store),
        FT.usage_metrics(fx.user_activity(spark, d), AS_OF_E, FT.FULL),
        FT.financial_metrics(fx.invoices(spark, d), AS_OF_O, FT.FULL),
        FT.support_metrics(tickets_for_window(spark, d), AS_OF_O, FT.FULL), AS_OF_O))


@register("merged_features_bucketed", O.q_merged())
def merged_features_bucketed(spark, d):
    """The five feature sets written as buckets of the customer, then merged
    without an exchange."""
    t = fixture_feature_tables(spark, d)
    sets = layout.bucketed(spark, {
        "base": FT.customer_base(t["customers"], FIXTURE_CLOCKS.customers, FT.CORE),
        "usage": FT.usage_metrics(t["user_activity"], FIXTURE_CLOCKS.activity, FT.CORE),
        "financial": FT.financial_metrics(t["invoices"], FIXTURE_CLOCKS.invoices, FT.CORE),
        "support": FT.support_metrics(t["support_tickets"], FIXTURE_CLOCKS.tickets, FT.CORE),
        "marketing": FT.marketing_metrics(t["marketing_engagement"], FIXTURE_CLOCKS.marketing, FT.CORE),
    }, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return X.fill_numeric_nulls(FT.merge_feature_sets(*sets.values()))


#: Days after the clock that are predicted; the last one pushes the watermark past the others.
_STREAM_DAYS = (0, 1, 5)


@register("stream_daily_once", _MERGED_WITH + f"""SELECT customer_id, prediction_id, prediction_date, 'v1.0' AS model_version, TRUE AS equals_batch
    FROM (SELECT customer_id, CAST({OR} AS DATE) + CAST(n AS INTEGER) AS prediction_date,
          md5(CAST(customer_id AS VARCHAR) || '|' || CAST(CAST({OR} AS DATE) + CAST(n AS INTEGER) AS VARCHAR) || '|v1.0') AS prediction_id
          FROM merged, UNNEST([{', '.join(map(str, _STREAM_DAYS))}]) t(n)) days""")
def stream_daily_once(spark, d):
    """Feature rows of three days arrive twice, in pieces, late and too late,
    each time with a restarted stream; every customer has one prediction a day,
    equal to scoring in batch."""
    data = ML.materialised(_merged(spark, d), "features")
    model = _train_model(spark, d)
    base = TB.scratch_path(spark, "stream")
    third = F.col("customer_id") % 3 == 0

    def arrive(*pieces):
        for rows, after in pieces:
            rows.withColumn("feature_time", F.lit(AS_OF_O + after * DAY + dt.timedelta(hours=6)).cast("timestamp")).write.mode(
                "append").parquet(f"{base}/in")
        schema = spark.read.parquet(f"{base}/in").schema
        score_stream_daily(spark, model, f"{base}/in", f"{base}/out", f"{base}/checkpoint", schema,
                           created_at=AS_OF_O).awaitTermination()

    arrive((data.where(~third), 0))
    arrive((data.where(~third), 0), (data, 1))       # a file that comes twice, and the next day
    arrive((data.where(third), 0), (data, 1))        # the rest of the first day, late
    arrive((data, 5))
    arrive((data, 0), (data, -3))                    # days the watermark has passed: refused
    days = [S.prediction_rows(ML.score(model, data), as_of=AS_OF_O + n * DAY, created_at=AS_OF_O) for n in _STREAM_DAYS]
    batch = days[0]
    for more in days[1:]:
        batch = batch.unionByName(more)
    want = batch.select("prediction_id", F.struct("churn_probability", "risk_tier").alias("want"))
    return TB.read_predictions(spark, f"{base}/out").join(want, "prediction_id", "left").select(
        "customer_id", "prediction_id", "prediction_date", "model_version",
        F.coalesce(F.struct("churn_probability", "risk_tier") == F.col("want"), F.lit(False)).alias("equals_batch"))


_BATCH_SQL = f"""batch AS (
    SELECT customer_id, customer_id AS named, 0 AS copy FROM customers
    UNION ALL SELECT customer_id + 1000000000, customer_id + 1000000000, 0 FROM customers WHERE customer_id % 7 = 0
    UNION ALL SELECT NULL, -customer_id, 0 FROM customers WHERE customer_id % 11 = 0
    UNION ALL SELECT customer_id, customer_id, 1 FROM customers WHERE customer_id % 13 = 0)"""


@register("checked_append", with_tables("customers", extra=[_BATCH_SQL]) + """SELECT run, customer_id,
    md5(CAST(named AS VARCHAR)) AS prediction_id, copy, reason FROM (
        SELECT 'all' AS run, *, CASE WHEN customer_id IS NULL THEN 'no customer' WHEN customer_id >= 1000000000 THEN 'unknown customer'
            WHEN customer_id % 2 = 0 THEN 'stored before' WHEN copy = 1 THEN 'repeated id' END AS reason FROM batch
        UNION ALL
        SELECT 'even', *, CASE WHEN customer_id >= 1000000000 THEN 'unknown customer' WHEN copy = 1 THEN 'repeated id' END
        FROM batch WHERE customer_id % 2 = 0) checked""")
def checked_append(spark, d):
    """Two runs with unknown and missing customers and repeated ids; the second
    also names what the first has stored. Stored and refused rows together."""
    base = TB.scratch_path(spark, "checked")
    customers = fx.customers(spark, d)
    c = F.col("customer_id")

    def rows(keep, named, who=c, copy=0):
        return customers.where(keep).select(
            F.md5(named.cast("string")).alias("prediction_id"), who.cast("long").alias("customer_id"),
            F.lit(AS_OF_O.date()).alias("prediction_date"), F.lit(0.5).cast("decimal(5,4)").alias("churn_probability"),
            F.lit("Medium Risk").alias("risk_tier"), F.lit("v1.0").alias("model_version"),
            F.lit(AS_OF_O + dt.timedelta(minutes=copy)).cast("timestamp_ntz").alias("created_at"))

    far = 1_000_000_000
    batch = ML.materialised(rows(F.lit(True), c).unionByName(rows(c % 7 == 0, c + far, c + far)).unionByName(
        rows(c % 11 == 0, -c, F.lit(None))).unionByName(rows(c % 13 == 0, c, copy=1)), "batch")
    for run, part in (("even", batch.where(c % 2 == 0)), ("all", batch)):
        CK.append_checked(spark, part, customers, f"{base}/store", f"{base}/refused", run)
    seen = L.read_runs(spark, f"{base}/store").withColumn("reason", F.lit(None).cast("string")).unionByName(
        CK.read_quarantine(spark, f"{base}/refused"))
    return seen.select(F.col("run_id").alias("run"), "customer_id", "prediction_id",
                       (F.col("created_at") > F.lit(AS_OF_O)).cast("int").alias("copy"), "reason")
