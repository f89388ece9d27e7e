"""Sources and sinks (S1 .. S4, S6): the five base tables, the CSV edge and
the prediction store."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

# Declared schemas of the business tables (inferred from column use).
SCHEMAS: dict[str, T.StructType] = {
    "customers": T.StructType([
        T.StructField("customer_id", T.LongType()),
        T.StructField("signup_date", T.TimestampNTZType()),
        T.StructField("account_status", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("company_size", T.StringType()),
        T.StructField("industry", T.StringType()),
        T.StructField("plan_type", T.StringType()),
        T.StructField("is_test_account", T.IntegerType()),
        T.StructField("company_name", T.StringType()),
        T.StructField("account_manager", T.StringType()),
    ]),
    "user_activity": T.StructType([
        T.StructField("customer_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("login_date", T.TimestampNTZType()),
        T.StructField("session_duration_minutes", T.DecimalType(10, 2)),
        T.StructField("feature_id", T.IntegerType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("api_calls", T.IntegerType()),
    ]),
    "invoices": T.StructType([
        T.StructField("customer_id", T.LongType()),
        T.StructField("amount", T.DecimalType(12, 2)),
        T.StructField("invoice_date", T.TimestampNTZType()),
        T.StructField("payment_status", T.StringType()),
    ]),
    "support_tickets": T.StructType([
        T.StructField("customer_id", T.LongType()),
        T.StructField("created_date", T.TimestampNTZType()),
        T.StructField("resolved_date", T.TimestampNTZType()),
        T.StructField("priority", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("satisfaction_score", T.IntegerType()),
    ]),
    "marketing_engagement": T.StructType([
        T.StructField("customer_id", T.LongType()),
        T.StructField("sent_date", T.TimestampNTZType()),
        T.StructField("opened", T.IntegerType()),
        T.StructField("clicked", T.IntegerType()),
        T.StructField("unsubscribed", T.IntegerType()),
        T.StructField("nps_score", T.IntegerType()),
        T.StructField("campaign_id", T.IntegerType()),
    ]),
    "churn_predictions": T.StructType([
        T.StructField("prediction_id", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("prediction_date", T.DateType()),
        T.StructField("churn_probability", T.DecimalType(5, 4)),
        T.StructField("risk_tier", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]),
}
JDBC_SPLIT = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
BASE_TABLES = ("customers", "user_activity", "invoices", "support_tickets", "marketing_engagement")


def load_tables(spark: SparkSession, src: str, names=BASE_TABLES, fmt: str = "parquet",
                options: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """One lazy DataFrame per table under ``src/<name>``.

    Parquet is read with its own schema and projected onto the declared one
    (so a missing column fails early). ``fmt="jdbc"`` reads ``<name>`` from
    the database at ``src`` (a JDBC URL); ``options`` must hold
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``:
    without them the whole table would come through one connection and task."""
    out = {}
    if fmt == "jdbc":
        missing = [k for k in JDBC_SPLIT if k not in (options or {})]
        if missing:
            raise ValueError(f"a JDBC read must be split: options lack {', '.join(missing)}")
    for name in names:
        schema = SCHEMAS[name]
        if fmt == "jdbc":
            reader = spark.read.format("jdbc").option("url", src).option("dbtable", name)
            for k, v in (options or {}).items():
                reader = reader.option(k, v)
            df = reader.load()
        elif fmt == "csv":
            df = read_csv(spark, f"{src.rstrip('/')}/{name}", schema)
        else:
            df = spark.read.format(fmt).options(**(options or {})).load(f"{src.rstrip('/')}/{name}")
        out[name] = df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return out


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and an explicit schema (no inference pass)."""
    return (spark.read.schema(schema).option("header", True)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
            .option("mode", "FAILFAST").csv(path))


def run_folder(base: str, run_date: dt.date | dt.datetime, prefix: str = "customer_data") -> str:
    """Date-stamped output folder, ``<base>/<prefix>_YYYYMMDD``."""
    return f"{base.rstrip('/')}/{prefix}_{run_date.strftime('%Y%m%d')}"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with a header, one file per task (never ``coalesce(1)``:
    that would funnel the whole table through one task)."""
    (df.write.mode(mode).option("header", True)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path))
    return path


def append_predictions(rows: DataFrame, path: str, run_id: str | None = None) -> str:
    """Add prediction rows to the store, partitioned by date and model
    version so a report over recent days prunes whole folders.

    Rows are appended, as by the reference's INSERT. With a ``run_id`` (a batch
    or stream batch that may be repeated after a failure) they replace what
    the same run wrote before and nothing else: the run is a partition below
    date and version, overwritten dynamically."""
    cols = [f.name for f in SCHEMAS["churn_predictions"].fields]
    (rows.select(*cols, F.lit(run_id or uuid.uuid4().hex).alias("run_id"))
     .write.partitionBy("prediction_date", "model_version", "run_id")
     .mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path))
    return path


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    schema = SCHEMAS["churn_predictions"]
    df = spark.read.schema(schema).parquet(path)
    return df.select(*[f.name for f in schema.fields])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never a
    machine-local temp folder, which other executors could not see)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/keepwise-{name}-{uuid.uuid4().hex[:12]}"
