"""ST1 with keyed state: one prediction per customer and day, however often
and however late the feature rows arrive.

Files of a stream come twice (a producer that retries), out of order and days
late. The stream keeps one key per customer and day in Spark's state store and
lets the first row of a key through to the model; repetitions are dropped before
they cost a scoring. The watermark bounds the state: keys of days that ended more
than ``watermark`` before the newest event are forgotten, and rows of such days,
which could no longer be told from repetitions, are refused. State, offsets and
the run names of the store's batches live in the checkpoint, so a restarted
stream goes on as if it had not stopped.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import config as C
from ..ml.train import score
from ..operators.scores import prediction_rows
from ..sources.tables import append_predictions

_DAY = "_feature_day"


def first_per_day(rows: DataFrame, event_time: str, watermark: str, key: str = "customer_id") -> DataFrame:
    """The first row of every ``key`` and day of ``event_time``; a stream keeps
    the keys of the days that the watermark has not passed."""
    # the window carries the watermark, so its keys leave the state when the day has passed
    marked = rows.withColumn(_DAY, F.col(event_time).cast("timestamp")).withWatermark(_DAY, watermark)
    return marked.withColumn(_DAY, F.window(_DAY, "1 day")).dropDuplicates([key, _DAY]).drop(_DAY)


def score_stream_daily(spark: SparkSession, model: PipelineModel | str, in_dir: str, out_dir: str, checkpoint: str,
                       schema: T.StructType, event_time: str = "feature_time", watermark: str = "2 days",
                       model_version: str = C.DEFAULT_MODEL_VERSION, available_now: bool = True,
                       max_files_per_trigger: int | None = None, created_at=None) -> StreamingQuery:
    """Score every customer once per day of ``event_time`` into the prediction
    store (dated by that day). Of several rows of a customer's day the first to
    arrive counts; rows without a customer or a time are left out."""
    if isinstance(model, str):
        model = PipelineModel.load(model)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(in_dir).where(F.col("customer_id").isNotNull() & F.col(event_time).isNotNull())
    once = first_per_day(rows, event_time, watermark)
    # the state has a task per shuffle partition; the few rows let through are scored in one task per core
    scored = score(model, once, keep=("customer_id", event_time))
    out = prediction_rows(scored, prediction_date=F.to_date(event_time), model_version=model_version, created_at=created_at)
    stream_id = md5(checkpoint.encode()).hexdigest()

    def store(batch: DataFrame, number: int) -> None:
        append_predictions(batch, out_dir, run_id=f"{stream_id}-{number}")

    writer = out.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
