"""End-to-end jobs: the three scripts of a retention pipeline as Spark jobs.

* ``extract_features``: five feature sets -> merged table -> dated CSV folder
  and a one-row summary (the extraction script).
* ``train_and_evaluate``: split -> fit -> cross-validate -> metrics ->
  importances -> model folder (the training script).
* ``daily_scoring``: features -> scores -> prediction store -> high-risk
  report (the daily scoring run).

Each stage stays a lazy DataFrame until it is written; nothing is collected
except the handful of metric values and the model.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import exprs as X
from ..ml import evaluate as EVAL
from ..ml import prep as P
from ..ml import train as ML
from ..ml.strata import stratified_split
from ..operators import features as FT
from ..operators import reports as R
from ..operators import scores as S
from ..sources import latest as LT
from ..sources import tables as TB


def extract_features(tables: dict[str, DataFrame], as_of, out_base: str, run_date: dt.date | None = None,
                     profile: str = FT.CORE) -> tuple[str, DataFrame]:
    """Write the merged feature table as CSV under ``out_base`` in a folder
    stamped with the run date; return the folder and the summary row."""
    feats = FT.build_features(tables, as_of, profile)
    clock = as_of.customers if isinstance(as_of, FT.Clocks) else as_of
    path = TB.run_folder(out_base, run_date or FT.as_datetime(clock))
    TB.write_csv(feats, path)
    spark = feats.sparkSession
    written = TB.read_csv(spark, path, feats.schema)
    return path, R.extraction_summary(written)


def train_and_evaluate(features: DataFrame, model_dir: str, params: C.ForestParams = C.ForestParams(),
                       split: C.SplitParams = C.SplitParams(), folds: int = 5,
                       label: str = "churned") -> dict[str, DataFrame]:
    """Fit on the training split, cross-validate, evaluate on the test split
    and save the model with its metrics. Returns the metric tables."""
    data = ML.materialised(stratified_split(features, label, "customer_id", split.test_fraction, split.seed), "split")
    train = data.where(F.col("split") == P.TRAIN).drop("split")
    test = data.where(F.col("split") == P.TEST).drop("split")
    model = ML.train(train, params, label)
    scored = ML.materialised(
        ML.score(model, test, keep=("customer_id", label)).withColumnRenamed(label, "label"), "scored")
    cols = {"probability": "churn_probability", "prediction": "prediction"}  # the model's own class
    out = {
        "class_balance": P.split_class_balance(data, label),
        "accuracy": EVAL.accuracy(scored, **cols),
        "roc_auc": EVAL.roc_auc(scored, probability="churn_probability"),
        "confusion_matrix": EVAL.confusion_matrix(scored, **cols),
        "classification_report": EVAL.classification_report(scored, **cols),
        "roc_curve": EVAL.roc_curve(scored, probability="churn_probability"),
        "feature_importance": ML.feature_importance(model, train),
    }
    if folds and folds > 1:
        out["cross_validation"] = ML.cross_validate(train, params, folds, label)
    metrics = {
        "accuracy": out["accuracy"].first()["accuracy"],
        "roc_auc": out["roc_auc"].first()["roc_auc"],
    }
    ML.save_model(model, model_dir, metrics=metrics, params=params, tables=out,
                  training_date=dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S"))
    TB.write_csv(out["feature_importance"], f"{model_dir}/feature_importance")
    return out


def daily_scoring(spark: SparkSession, tables: dict[str, DataFrame], model: PipelineModel | str,
                  store_path: str, as_of, model_version: str = C.DEFAULT_MODEL_VERSION,
                  clocks: FT.Clocks | None = None, created_at=None) -> DataFrame:
    """Score every customer of the base at ``as_of``, add the rows to the
    prediction store and return the high-risk report.

    A repeated run of the same day and version replaces its own rows. The report
    reads the latest prediction per customer from the table kept next to the
    store (``<store>_latest``), which takes in this run's rows only. The three
    fact tables are aggregated once: the sets are written, and both the feature
    table and the report read them."""
    if isinstance(model, str):
        model = ML.load_model(model)
    clocks = clocks or FT.Clocks.single(as_of)
    sets = {
        "usage": ML.materialised(FT.usage_metrics(tables["user_activity"], clocks.activity, FT.CORE), "usage"),
        "financial": ML.materialised(FT.financial_metrics(tables["invoices"], clocks.invoices, FT.CORE), "financial"),
        "support": ML.materialised(FT.support_metrics(tables["support_tickets"], clocks.tickets, FT.CORE), "support"),
    }
    feats = X.fill_numeric_nulls(FT.merge_feature_sets(
        FT.customer_base(tables["customers"], clocks.customers, FT.CORE), *sets.values(),
        FT.marketing_metrics(tables["marketing_engagement"], clocks.marketing, FT.CORE)))
    rows = S.prediction_rows(ML.score(model, feats), as_of=as_of, model_version=model_version, created_at=created_at)
    run_id, latest_path = f"daily-{FT.as_datetime(as_of):%Y%m%d}-{model_version}", f"{store_path.rstrip('/')}_latest"
    TB.append_predictions(rows, store_path, run_id=run_id)
    LT.update_latest(spark, latest_path, store_path, run_id)
    preds = LT.read_latest(spark, latest_path, clocks.customers, store_path)
    return R.high_risk_report(tables["customers"], preds, sets["usage"], sets["financial"], sets["support"],
                              clocks.customers)
