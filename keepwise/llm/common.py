"""Helpers shared by the training-data operators: Arrow-batched annotation of
one text column and tables written to the shared scratch folder."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from keepwise.sources.tables import scratch_path

#: Rows per Arrow batch: texts may be long, and a batch is held in memory whole.
BATCH_ROWS = 1000
PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def col(name: str):
    """Column by its literal name (names may hold dots)."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the
    lineage with files every executor (and its replacement) can read."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that grows with the documents: never a
    broadcast. Spark takes an exploded table for as small as its source, and a
    written one for as small as its compressed files, so that what it holds
    below the broadcast threshold may be many times the driver's memory."""
    return df.hint("merge")


def ready_workers(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for long texts, and let Python workers
    import this package from where the driver did (a shared or local install;
    elsewhere pass it with ``--py-files``)."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [PACKAGE_ROOT, *paths]))


def annotate(
    df: DataFrame,
    column: str,
    fields: StructType,
    make: Callable[[], Callable[[list], Sequence[pa.Array]]],
    keep: Sequence[str],
) -> DataFrame:
    """``keep`` columns of ``df`` plus ``fields`` computed from ``column``.

    ``make`` runs once per task and returns a function from the batch's values
    (``None`` for null) to one Arrow array per field. Columns travel by
    position, so names in ``df`` cannot clash with anything inside.
    """
    ready_workers(df.sparkSession)
    n = len(keep)
    at = list(keep).index(column) if column in keep else n
    src = df.select(*[col(c).alias(f"k{i}") for i, c in enumerate(keep)],
                    *([] if at < n else [col(column).alias("x")]))
    schema = StructType([StructField(f"k{i}", df.schema[c].dataType) for i, c in enumerate(keep)] + fields.fields)

    def run(batches):
        compute = make()
        for batch in batches:
            made = compute(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *made], names=schema.names)

    return src.mapInArrow(run, schema).toDF(*keep, *fields.names)
