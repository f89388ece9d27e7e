"""Feature sets kept co-partitioned on the customer.

The merge of the customer base with its feature sets joins five tables on one
key. Stored as buckets of that key (and sorted by it), every set is shuffled
once, when it is written; each merge after that, and any other join or grouping
by customer, reads matching buckets side by side without an exchange.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .tables import scratch_path

KEY = "customer_id"


def save_bucketed(df: DataFrame, name: str, buckets: int, path: str | None = None, key: str = KEY) -> str:
    """Write ``df`` as table ``name`` in ``buckets`` buckets of ``key``, sorted
    by it. Rows are dealt to the buckets first, so every bucket is one file.
    ``path`` makes it an external table in a folder all executors share. Sets
    meant to be joined must have the same number of buckets, sized to the
    largest one (a few hundred MB a bucket)."""
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return name


def bucketed(spark: SparkSession, sets: dict[str, DataFrame], buckets: int, prefix: str | None = None) -> dict[str, DataFrame]:
    """Write every set under a scratch folder and return it read back from its
    buckets."""
    prefix = prefix or f"keepwise_{uuid.uuid4().hex[:8]}"
    base = scratch_path(spark, "buckets")
    return {n: spark.table(save_bucketed(df, f"{prefix}_{n}", buckets, f"{base}/{n}")) for n, df in sets.items()}
