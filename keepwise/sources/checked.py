"""Appends to the prediction store that keep its key and its reference to the
customers (S4, J6).

A database refuses an INSERT that repeats a primary key or names a customer that
does not exist. Files refuse nothing, so the rows of a batch are checked before
they are written, and those refused go to a quarantine with the reason:

* ``no customer``: the id is null; ``unknown customer``: it is not in the table;
* ``repeated id``: another row of the batch has the prediction id (the first
  inserted stays); ``stored before``: another run's row has it.

A batch is small against all customers, so the customers are not shuffled for
the check: a Bloom filter of the batch's ids (bitmaps, at most ``MAX_BITS`` bits,
so it can be broadcast whatever the batch) is tested where the customers lie,
and only the few that pass meet the batch in an exact join. False hits cost a row
in that join, never a wrong answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import SCHEMAS, append_predictions, scratch_path

KEY = "customer_id"
#: Bits per id of the batch, hash functions, and the bound of the whole filter: 2**27 bits are 16 MB a function.
BITS_PER_ID = 16
HASHES = 2
MAX_BITS = 1 << 27
#: Bits of one bitmap of Spark's bitmap functions.
_PAGE = 32_768
REFUSED_SCHEMA = T.StructType([*SCHEMAS["churn_predictions"].fields, T.StructField("reason", T.StringType()),
                               T.StructField("run_id", T.StringType())])


def _bit(key: Column, n: int, pages: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(n)), F.lit(pages * _PAGE))


def bloom_pages(ids: DataFrame, key: str, pages: int) -> DataFrame:
    """(hash function, page, bitmap) of the non-null ids."""
    bits = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), _bit(F.col(key), n, pages).alias("bit")) for n in range(HASHES)]))
    return (ids.where(F.col(key).isNotNull()).select(bits.alias("b")).select("b.n", F.floor(F.col("b.bit") / _PAGE).alias("page"), (F.col("b.bit") % _PAGE).alias("at"))
            .groupBy("n", "page").agg(F.bitmap_construct_agg("at").alias("bitmap")))


def may_hold(df: DataFrame, key: str, filter_pages: DataFrame, pages: int) -> DataFrame:
    """Rows of ``df`` whose key passes every hash function: all that are in
    the filter and few others. The filter is broadcast: at most ``MAX_BITS`` bits
    a function."""
    out = df
    for n in range(HASHES):
        own = F.broadcast(filter_pages.where(F.col("n") == n).select(F.col("page").alias(f"_p{n}"), F.col("bitmap").alias(f"_m{n}")))
        bit = _bit(F.col(key), n, pages)
        byte = F.conv(F.hex(F.expr(f"substring(_m{n}, cast(_at div 8 as int) + 1, 1)")), 16, 10).cast("int")
        held = F.call_function("shiftright", byte, (F.col("_at") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
        out = (out.withColumn("_page", F.floor(bit / _PAGE)).withColumn("_at", bit % _PAGE)
               .join(own, F.col("_page") == F.col(f"_p{n}")).where(held).drop("_page", "_at", f"_p{n}", f"_m{n}"))
    return out


def check_rows(rows: DataFrame, customers: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``reason`` (null for rows that may be stored). ``rows``
    must be cheap to read twice (a written table). ``stored`` are the
    prediction ids that other runs hold."""
    n = rows.agg(F.approx_count_distinct(KEY).alias("n")).first()["n"]
    pages = max(1, min(MAX_BITS, n * BITS_PER_ID) // _PAGE + 1)
    ids = rows.select(KEY).where(F.col(KEY).isNotNull()).distinct()
    known = may_hold(customers.select(F.col(KEY).cast("long").alias("_known")), "_known", bloom_pages(ids, KEY, pages), pages)
    out = rows.join(known.distinct(), F.col(KEY) == F.col("_known"), "left")
    # rows that repeat an id are few in a sound batch: numbered per id, refused from the second on
    order = Window.partitionBy("prediction_id").orderBy("created_at", F.xxhash64(*rows.columns))
    out = out.withColumn("_n", F.row_number().over(order))
    if stored is not None:
        held = stored.select(F.col("prediction_id").alias("_held")).distinct()
        out = out.join(held, F.col("prediction_id") == F.col("_held"), "left")
    else:
        out = out.withColumn("_held", F.lit(None).cast("string"))
    reason = (F.when(F.col(KEY).isNull(), "no customer").when(F.col("_known").isNull(), "unknown customer")
              .when(F.col("_held").isNotNull(), "stored before").when(F.col("_n") > 1, "repeated id"))
    return out.select(*rows.columns, reason.alias("reason"))


def append_checked(spark: SparkSession, rows: DataFrame, customers: DataFrame, store: str, quarantine: str, run_id: str) -> None:
    """Append the rows that pass ``check_rows`` to the store under ``run_id``
    and the others, with their reason, to the quarantine. A repeated run replaces
    its own rows in both."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    exists = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path)
    names = SCHEMAS["churn_predictions"].names
    path = scratch_path(spark, "batch")
    rows.select(*names).write.parquet(path)
    batch = spark.read.schema(SCHEMAS["churn_predictions"]).parquet(path)
    stored = None
    if exists:
        # an id holds its day, so only the batch's days of the store are read
        first, last = batch.agg(F.min("prediction_date"), F.max("prediction_date")).first()
        schema = T.StructType([*SCHEMAS["churn_predictions"].fields, T.StructField("run_id", T.StringType())])
        stored = spark.read.schema(schema).parquet(store).where(
            F.col("prediction_date").between(F.lit(first), F.lit(last)) & ~F.col("run_id").eqNullSafe(F.lit(run_id)))
    checked_path = scratch_path(spark, "checked")
    check_rows(batch, customers, stored).write.parquet(checked_path)
    checked = spark.read.parquet(checked_path)
    append_predictions(checked.where("reason is null"), store, run_id=run_id)
    (checked.where("reason is not null").withColumn("run_id", F.lit(run_id)).select(*REFUSED_SCHEMA.names)
     .write.partitionBy("run_id").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(quarantine))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REFUSED_SCHEMA).parquet(path)
