"""The latest prediction per customer as a maintained table.

The prediction store keeps every run; a report wants one row per customer.
Instead of reducing the whole history each time, a small table follows the
store: after every run it takes in that run's rows and nothing else. It holds
exactly what reducing the whole store would give, in whatever order runs arrive:

* a late run (an older day scored afterwards) loses against newer rows by the
  same order (date, insert time, id) that decides within the history;
* a repeated run replaces its own rows in the store. Customers whose latest row
  came from its earlier content are looked up in the history once more, only
  they.

Every update writes a new version folder and readers take the newest complete
one, so a failed update changes nothing and can be repeated. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates
from ..operators.scores import latest_prediction
from .tables import SCHEMAS, read_predictions

_SCHEMA = T.StructType([*SCHEMAS["churn_predictions"].fields, T.StructField("run_id", T.StringType())])
#: Versions kept for readers that still use them.
KEEP_VERSIONS = 2


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions under ``path``, oldest first."""
    fs, at = _folder(spark, path)
    if not fs.exists(at):
        return []
    found = [s.getPath() for s in fs.listStatus(at)]
    done = [p.getName()[1:] for p in found if p.getName().startswith("v") and fs.exists(_folder(spark, f"{p}/_SUCCESS")[1])]
    return sorted(int(v) for v in done if v.isdigit())


def read_runs(spark: SparkSession, store: str) -> DataFrame:
    """The prediction store with each row's run."""
    return spark.read.schema(_SCHEMA).parquet(store)


def update_latest(spark: SparkSession, path: str, store: str, run_id: str) -> int:
    """Take the rows of one (new, late or repeated) run of the store into the
    latest table under ``path``; returns the version written. The first update
    builds the table from the whole store."""
    runs, have = read_runs(spark, store), versions(spark, path)
    if have:
        current = spark.read.schema(_SCHEMA).parquet(f"{path}/v{have[-1]}")
        own = F.col("run_id").eqNullSafe(F.lit(run_id))
        rows = current.where(~own).unionByName(runs.where(own))
        # their latest row came from what this run held before it was repeated
        stale = current.where(own).select("customer_id")
        if stale.head(1):
            rows = rows.unionByName(runs.where(~own).join(stale, "customer_id", "left_semi").select(*rows.columns))
    else:
        rows = runs
    number = have[-1] + 1 if have else 0
    latest_prediction(rows).select(*_SCHEMA.names).write.mode("overwrite").parquet(f"{path}/v{number}")
    fs, _ = _folder(spark, path)
    for old in have[: -(KEEP_VERSIONS - 1) or None]:
        fs.delete(_folder(spark, f"{path}/v{old}")[1], True)
    return number


def read_latest(spark: SparkSession, path: str, as_of=None, store: str | None = None) -> DataFrame:
    """The newest version of the table. With ``as_of`` only predictions dated
    up to that day count: customers with a newer row are looked up in ``store``."""
    have = versions(spark, path)
    if not have:
        raise FileNotFoundError(f"no complete version under {path}")
    table = spark.read.schema(_SCHEMA).parquet(f"{path}/v{have[-1]}").drop("run_id")
    if as_of is None:
        return table
    early = F.col("prediction_date") <= F.to_date(dates.as_of_literal(as_of))
    newer = table.where(~early).select("customer_id")
    out = table.where(early)
    if newer.head(1):
        if store is None:
            raise ValueError("the table holds predictions after the clock; name the store to look further back")
        past = read_predictions(spark, store).join(newer, "customer_id", "left_semi")
        out = out.unionByName(latest_prediction(past, as_of=as_of).select(*out.columns))
    return out
