"""Churn classifier as a Spark ML pipeline (M1, M3, M5 .. M7, M12, S5).

Encoding, assembly, scaling and the forest are pipeline stages, so
cross-validation refits all of them per fold and one ``PipelineModel``
directory holds everything needed to score. Training is distributed
(level-by-level histogram aggregation); nothing is collected except the
model itself and its per-feature importances.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (
    OneHotEncoder, StandardScaler, StandardScalerModel, StringIndexer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import exprs as X
from ..sources.tables import scratch_path
from .prep import add_class_weight
from .strata import stratified_folds

LABEL = "churned"
WEIGHT = "class_weight"
RAW = "raw_features"
FEATURES = "features"
#: Rows of a training partition at most: one holds about 2 kB a row (bin numbers, and per tree a sample count and a node id).
FIT_ROWS = 250_000


def feature_columns(df: DataFrame, exclude: Sequence[str] = C.EXCLUDED_FEATURE_COLUMNS) -> tuple[list[str], list[str]]:
    """(numeric, categorical) model inputs: every column not excluded; the
    string columns are the categorical ones, whichever they are."""
    own = (WEIGHT, "split", "fold")
    keep = X.select_excluding(df, [*exclude, *own])
    return X.numeric_columns(keep), [f.name for f in keep.schema.fields if isinstance(f.dataType, T.StringType)]


def encode_stages(cat_cols: Sequence[str]) -> list:
    """M1: categorical strings -> index -> one-hot. Unseen values get their
    own slot instead of failing at scoring time."""
    if not cat_cols:
        return []
    idx = [f"{c}__idx" for c in cat_cols]
    return [
        StringIndexer(inputCols=list(cat_cols), outputCols=idx, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=idx, outputCols=[f"{c}__vec" for c in cat_cols], handleInvalid="keep"),
    ]


def scaler_stages(numeric_cols: Sequence[str], cat_cols: Sequence[str]) -> list:
    """M3: assemble numeric and one-hot columns, then standardise (mean and
    sample std from the training rows only). Numeric NULLs are filled before
    (``filled``); one that got through would make its column NaN, so it fails."""
    inputs = list(numeric_cols) + [f"{c}__vec" for c in cat_cols]
    return [
        VectorAssembler(inputCols=inputs, outputCol=RAW, handleInvalid="error"),
        StandardScaler(inputCol=RAW, outputCol=FEATURES, withMean=True, withStd=True),
    ]


def fit_scaler(df: DataFrame) -> PipelineModel:
    """M1 and M3 alone: encoder and scaler fitted on ``df``, as the pipeline of the forest fits them."""
    num, cats = feature_columns(df)
    return Pipeline(stages=encode_stages(cats) + scaler_stages(num, cats)).fit(filled(df))


def fitted_scaler(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, mean, std) of every slot of the fitted scaler of a pipeline
    (one row per model input: model-sized)."""
    scaler = next(s for s in model.stages if isinstance(s, StandardScalerModel))
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    plain = [c for c in assembler.getInputCols() if not c.endswith("__vec")]
    # the numeric columns come first; the slots of the encoded ones have no name of their own
    names = plain + [f"slot{i}" for i in range(len(plain), len(scaler.mean))]
    return spark.createDataFrame([(n, float(m), float(s)) for n, m, s in zip(names, scaler.mean, scaler.std)],
                                 "feature string, mean double, std double")


def forest(params: C.ForestParams = C.ForestParams(), label: str = LABEL,
           weight_col: str | None = WEIGHT) -> RandomForestClassifier:
    """M5: the reference's forest. ``min_samples_split=20`` needs no own
    setting: two children of at least 10 rows imply a parent of 20."""
    # Node ids are cached and checkpointed every 10 levels, so a depth-15
    # forest does not rebuild a long lineage after a lost executor (the
    # checkpoint folder is the session's shared spark.checkpoint.dir).
    rf = RandomForestClassifier(
        featuresCol=FEATURES, labelCol=label, numTrees=params.num_trees, maxDepth=params.max_depth,
        minInstancesPerNode=params.min_instances_per_node,
        featureSubsetStrategy=params.feature_subset_strategy, seed=params.seed,
        cacheNodeIds=True, checkpointInterval=10,
    )
    if weight_col:
        rf = rf.setWeightCol(weight_col)
    return rf


def build_pipeline(numeric_cols, cat_cols, params: C.ForestParams = C.ForestParams(),
                   label: str = LABEL) -> Pipeline:
    weight = WEIGHT if params.class_weight_balanced else None
    return Pipeline(stages=encode_stages(cat_cols) + scaler_stages(numeric_cols, cat_cols)
                    + [forest(params, label, weight)])


def filled(df: DataFrame) -> DataFrame:
    """Numeric model inputs without NULLs, for fitting and scoring alike (0, as
    the reference fills them). A NULL string falls into the encoder's slot for
    unknown values."""
    num, _ = feature_columns(df)
    return df.na.fill(0, subset=num) if num else df


def materialised(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared scratch folder and read back, so that the
    passes of a fit read prepared rows instead of the raw tables."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fit_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions of a forest's training rows: one per core, more only if one
    would hold over ``FIT_ROWS``. Every partition sends a whole histogram for every node
    of every pass, however few of its rows are there, so partitions beyond
    the cores add shuffled bytes and no speed."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // FIT_ROWS))


def prepare_training(df: DataFrame, label: str = LABEL, id_col: str = "customer_id",
                     params: C.ForestParams = C.ForestParams()) -> DataFrame:
    """Filled features, label as double, balanced weights, and a stable layout
    (hash partitioned and sorted by id) so a seeded fit is repeatable on
    equally many cores. The input is evaluated once: weights and every pass of
    the fit read the rows written here."""
    out = materialised(filled(df).withColumn(label, F.col(label).cast("double")), "training")
    n = fit_partitions(df.sparkSession, out.count())
    if params.class_weight_balanced:
        out = add_class_weight(out, label, WEIGHT)
    return out.repartition(n, id_col).sortWithinPartitions(id_col)


def train(df: DataFrame, params: C.ForestParams = C.ForestParams(), label: str = LABEL,
          numeric_cols=None, cat_cols=None) -> PipelineModel:
    """M5: fit encoder, scaler and forest on ``df`` (the training split)."""
    num, cats = feature_columns(df)
    numeric_cols = list(numeric_cols) if numeric_cols is not None else num
    cat_cols = list(cat_cols) if cat_cols is not None else cats
    data = prepare_training(df, label, params=params)
    return build_pipeline(numeric_cols, cat_cols, params, label).fit(data)


def score(model: PipelineModel, df: DataFrame, probability_col: str = "churn_probability",
          keep: Sequence[str] | None = ("customer_id",), spread_key: str | None = "customer_id",
          partitions: int | None = None) -> DataFrame:
    """M7: class and positive-class probability for every row, as plain
    columns (the model's vectors are dropped). NULL inputs are filled as in
    training.

    Scoring costs CPU per row (every tree is walked), while AQE sizes
    partitions by bytes: a feature table of millions of narrow rows ends up
    in a handful of partitions. Rows are therefore hash-spread on
    ``spread_key`` (unique per row, so balanced) over ``partitions`` (default:
    one per core). Every task unpacks the whole forest before its first row,
    and the forest grows with the training rows: more tasks than cores would
    only unpack it more often."""
    if spread_key and spread_key in df.columns:
        n = partitions or df.sparkSession.sparkContext.defaultParallelism
        df = df.repartition(n, spread_key)
    out = model.transform(filled(df))
    cols = list(keep) if keep is not None else list(df.columns)
    return out.select(*cols, vector_to_array(F.col("probability"))[1].alias(probability_col),
                      F.col("prediction").cast("int").alias("prediction"))


def folds_at_once(spark: SparkSession, rows: int, folds: int) -> int:
    """Fits that run side by side: as many as hold at most ``FIT_ROWS`` rows a
    core together. A fit leaves cores idle between its passes, which another
    one uses; rows beyond that would be written to disk and read again in every pass."""
    return max(1, min(folds, FIT_ROWS * spark.sparkContext.defaultParallelism // max(1, rows)))


def cross_validate(df: DataFrame, params: C.ForestParams = C.ForestParams(), folds: int = 5,
                   label: str = LABEL, id_col: str = "customer_id", parallelism: int | None = None) -> DataFrame:
    """M6: k-fold cross-validated ROC-AUC of the whole pipeline; the folds cut
    every class into equal parts (to within one row) in the order of a hash of
    the id, so they are repeatable. Every fold is one fit and one evaluation;
    no model is fitted on all rows, as none is asked for. ``parallelism``: fits
    at once (default: ``folds_at_once``)."""
    num, cats = feature_columns(df)
    spark = df.sparkSession
    # written with weights and folds: every fold's fits and evaluations read these rows
    data = materialised(stratified_folds(prepare_training(df, label, id_col, params), label, id_col, folds, params.seed),
                        "folds")
    sizes = {r["fold"]: r["count"] for r in data.groupBy("fold").count().collect()}
    rows = sum(sizes.values())
    for k in range(folds):
        if not sizes.get(k) or sizes[k] == rows:
            raise ValueError(f"no rows to {'evaluate' if not sizes.get(k) else 'fit'} fold {k} on")
    pipe = build_pipeline(num, cats, params, label)
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="probability",
                                       metricName="areaUnderROC")

    def auc(k: int) -> float:
        fitted = pipe.fit(data.where(F.col("fold") != k))
        return ev.evaluate(fitted.transform(data.where(F.col("fold") == k)))

    with ThreadPool(parallelism or folds_at_once(spark, rows - min(sizes.values()), folds)) as pool:
        found = pool.map(inheritable_thread_target(spark)(auc), range(folds), chunksize=1)
    mean, std = float(np.mean(found)), float(np.std(found))
    return spark.createDataFrame(
        [("roc_auc", folds, mean, std, mean - 2 * std, mean + 2 * std)],
        "metric string, folds int, mean double, std double, lower double, upper double")


def feature_importance(model: PipelineModel, df: DataFrame, top_n: int | None = None) -> DataFrame:
    """Forest importances per input column (one-hot slots summed back to
    their source column), largest first. The vector has one entry per model
    input, so it is model-sized, not data-sized."""
    rf = model.stages[-1]
    schema = model.transform(df.limit(0)).schema
    meta = schema[FEATURES].metadata
    if "attrs" not in meta.get("ml_attr", {}):
        meta = schema[RAW].metadata  # the scaler keeps only the attribute count
    attrs = []
    for group in meta.get("ml_attr", {}).get("attrs", {}).values():
        attrs.extend(group)
    names = {a["idx"]: a["name"] for a in attrs}
    imp = rf.featureImportances.toArray()
    total: dict[str, float] = {}
    for i, v in enumerate(imp):
        name = names.get(i, f"f{i}")
        source = name.split("__vec")[0] if "__vec" in name else name
        total[source] = total.get(source, 0.0) + float(v)
    rows = sorted(total.items(), key=lambda kv: (-kv[1], kv[0]))
    if top_n is not None:
        rows = rows[:top_n]
    spark = df.sparkSession
    return spark.createDataFrame([(k, v, i + 1) for i, (k, v) in enumerate(rows)],
                                 "feature string, importance double, rank int")


def save_model(model: PipelineModel, path: str, metrics: dict | None = None,
               params: C.ForestParams | None = None, training_date: str | None = None,
               tables: dict[str, DataFrame] | None = None) -> str:
    """The pipeline folder, a one-row Parquet table with scalar metrics,
    parameters and training date, and one Parquet table per entry of ``tables``
    (confusion matrix, report, cross-validation, importances, ...). No pickle:
    loading runs no code."""
    model.write().overwrite().save(f"{path}/pipeline")
    spark = (next(iter(tables.values())).sparkSession if tables else SparkSession.active())
    info = [(json.dumps(metrics or {}), json.dumps(asdict(params) if params else {}), training_date or "",
             json.dumps(sorted(tables or {})))]
    spark.createDataFrame(info, "metrics string, params string, training_date string, tables string") \
        .write.mode("overwrite").parquet(f"{path}/info")
    for name, df in (tables or {}).items():
        df.write.mode("overwrite").parquet(f"{path}/tables/{name}")
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/pipeline")


def load_artifact(spark: SparkSession, path: str) -> dict:
    """Everything ``save_model`` stored: model, metrics, params, training_date
    and the tables by name."""
    info = spark.read.parquet(f"{path}/info").first()
    return {"model": load_model(path), "metrics": json.loads(info["metrics"]),
            "params": C.ForestParams(**json.loads(info["params"])), "training_date": info["training_date"],
            "tables": {n: spark.read.parquet(f"{path}/tables/{n}") for n in json.loads(info["tables"])}}
