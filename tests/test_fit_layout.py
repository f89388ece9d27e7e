"""Forest fits and scoring run in as many tasks as there are cores."""

from __future__ import annotations

import pytest
from keepwise import config as C
from keepwise.ml import train as ML
from keepwise.plans import analytics as A
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from .conftest import SF_SMALL


def _rows(spark, n=400):
    return spark.range(n).selectExpr("id AS customer_id", "CAST(id % 7 AS DOUBLE) AS a", "CAST(id % 11 AS DOUBLE) AS b",
                                     "CAST(id % 7 > 3 AS INT) AS churned")


def test_partitions_follow_cores_and_rows_not_shuffle_partitions(spark):
    cores = spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(cores + 57))
    try:
        data = ML.prepare_training(_rows(spark))
        assert data.rdd.getNumPartitions() == cores
        assert ML.fit_partitions(spark, ML.FIT_ROWS * cores + 1) == cores + 1
        model = ML.train(_rows(spark), C.ForestParams(num_trees=3, max_depth=3))
        scored = ML.score(model, _rows(spark))
        assert scored.rdd.getNumPartitions() == cores and scored.count() == 400
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_cross_validation_fits_each_fold_once_and_agrees_with_the_library(spark, monkeypatch):
    rows = spark.range(600).selectExpr("id AS customer_id", "CAST(hash(id) % 50 AS DOUBLE) AS a", "CAST(hash(id, 1) % 30 AS DOUBLE) AS b",
                                       "CAST(hash(id) % 50 + hash(id, 2) % 40 > 5 AS INT) AS churned")
    params, fits, once = C.ForestParams(num_trees=4, max_depth=3), [], ML.Pipeline.fit

    def counted(self, data, *rest):
        fits.append(data.select("fold").distinct().count())
        return once(self, data, *rest)

    monkeypatch.setattr(ML.Pipeline, "fit", counted)
    got = ML.cross_validate(rows, params, folds=3).first()
    assert fits == [2, 2, 2]
    monkeypatch.undo()
    data = ML.materialised(ML.stratified_folds(ML.prepare_training(rows, params=params), "churned", "customer_id", 3, params.seed), "folds")
    library = CrossValidator(estimator=ML.build_pipeline(*ML.feature_columns(rows), params), estimatorParamMaps=[{}],
                             evaluator=BinaryClassificationEvaluator(labelCol="churned", rawPredictionCol="probability"),
                             numFolds=3, foldCol="fold").fit(data)
    assert abs(got["mean"] - library.avgMetrics[0]) < 1e-9 and abs(got["std"] - library.stdMetrics[0]) < 1e-9
    assert got["upper"] - got["lower"] == pytest.approx(4 * got["std"])


def test_folds_run_side_by_side_as_far_as_their_rows_fit(spark):
    cores = spark.sparkContext.defaultParallelism
    assert ML.folds_at_once(spark, 100, 5) == 5 and ML.folds_at_once(spark, 0, 5) == 5
    assert ML.folds_at_once(spark, ML.FIT_ROWS * cores // 2, 5) == 2 and ML.folds_at_once(spark, ML.FIT_ROWS * cores * 9, 5) == 1


def test_a_class_of_one_row_leaves_folds_without_rows(spark):
    rows = _rows(spark, 3).withColumn("churned", F.lit(1))
    with pytest.raises(ValueError, match="fold"):
        ML.cross_validate(rows, C.ForestParams(num_trees=2, max_depth=2), folds=5)


def test_save_and_load_builds_the_features_once(spark, monkeypatch):
    built, merged, fewer = [], A._merged, C.ForestParams(num_trees=2, max_depth=2)
    monkeypatch.setattr(A, "_merged", lambda *x: built.append(1) or merged(*x))
    monkeypatch.setattr(ML.train, "__defaults__", (fewer, *ML.train.__defaults__[1:]))
    rows = A.model_save_load(spark, SF_SMALL).collect()
    assert len(built) == 1 and rows and all(r.same and r.metrics_kept for r in rows)
