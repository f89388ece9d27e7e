"""ST1: score feature rows as they arrive and append prediction rows.

A file-source stream (new Parquet files in ``in_dir``) goes through the saved
``PipelineModel`` and the tier rule into the prediction store, by the same
writer as the batch run. The query is stateless, so it needs no watermark. The
checkpoint folder records which files were consumed, and each micro-batch is
one run of the store (named after the query and the batch), so a batch that is
repeated after a failure replaces its own rows and nothing else.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import config as C
from ..ml.train import score
from ..operators.scores import prediction_rows
from ..sources.tables import append_predictions


def score_stream(spark: SparkSession, model: PipelineModel | str, in_dir: str, out_dir: str,
                 checkpoint: str, schema: T.StructType, as_of=None,
                 model_version: str = C.DEFAULT_MODEL_VERSION, available_now: bool = True,
                 max_files_per_trigger: int | None = None, created_at=None) -> StreamingQuery:
    """Start the scoring stream and return the query handle.

    ``available_now=True`` processes everything present and stops (batch
    catch-up, used by the daily run and the tests); ``False`` keeps polling.
    """
    stream_id = md5(checkpoint.encode()).hexdigest()  # the same after a restart from this checkpoint
    if isinstance(model, str):
        model = PipelineModel.load(model)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(in_dir)
    scored = score(model, rows, keep=("customer_id",))
    out = prediction_rows(scored, as_of=as_of, model_version=model_version, created_at=created_at)

    def store(batch: DataFrame, number: int) -> None:
        append_predictions(batch, out_dir, run_id=f"{stream_id}-{number}")

    writer = out.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
