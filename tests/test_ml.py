"""Evaluation metrics, split, weights, scaler statistics, the forest and the
scoring stream."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from keepwise import config as C
from keepwise.ml import evaluate as EVAL
from keepwise.ml import prep as P
from keepwise.ml import train as ML
from keepwise.sources import tables as TB

SMALL = C.ForestParams(num_trees=20, max_depth=5)


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(2000):
        y = 1 if rnd.random() < 0.4 else 0
        p = min(1.0, max(0.0, rnd.gauss(0.6 if y else 0.4, 0.2)))
        rows.append((i, y, p if i % 3 else round(p, 2)))  # distinct and tied scores
    return spark.createDataFrame(rows, "id long, label int, probability double").repartition(5)


def brute_auc(rows):
    pos = [p for _, y, p in rows if y == 1]
    neg = [p for _, y, p in rows if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def test_auc_exact_against_brute_force_and_evaluator(spark, labelled):
    rows = [tuple(r) for r in labelled.collect()]
    got = EVAL.roc_auc(labelled).first()["roc_auc"]
    assert got == pytest.approx(brute_auc(rows), abs=1e-12)
    vec = labelled.select(F.col("label").cast("double").alias("label"),
                          F.array(1 - F.col("probability"), F.col("probability")).alias("a"))
    from pyspark.ml.functions import array_to_vector
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="raw").evaluate(
        vec.select("label", array_to_vector("a").alias("raw")))
    assert got == pytest.approx(ev, abs=1e-9)


def test_auc_and_curve_do_not_round_scores(spark):
    """20,000 distinct scores within a hundredth."""
    rnd = random.Random(7)
    rows = [(i, int(rnd.random() < 0.3 + 40 * (p := rnd.random() / 100)), p) for i in range(20_000)]
    df = spark.createDataFrame(rows, "id long, label int, probability double").repartition(6)
    order = sorted(rows, key=lambda r: r[2])
    neg = u = 0
    for _, y, _ in order:
        u, neg = (u + neg, neg) if y else (u, neg + 1)
    assert EVAL.roc_auc(df).first()["roc_auc"] == u / (neg * (len(rows) - neg))
    curve = EVAL.roc_curve(df)
    assert curve.count() == 20_001
    last = curve.orderBy("threshold").first()
    assert (last["fpr"], last["tpr"]) == (1.0, 1.0)


def test_auc_of_billions_of_rows_does_not_overflow(spark, monkeypatch):
    n = 3 * 10**9
    counts = spark.createDataFrame([(0.2, n // 2, n), (0.8, n, n // 2)], "score double, pos long, neg long")
    monkeypatch.setattr(EVAL, "score_counts", lambda *a, **k: counts)
    got = EVAL.roc_auc(counts).first()
    assert got["positives"] == got["negatives"] == n + n // 2
    assert got["roc_auc"] == pytest.approx((n // 2 * n / 2 + n * (n + n // 4)) / (1.5 * n) ** 2)


def test_nulls_are_filled_before_fit_and_score(spark, planted):
    holes = planted.withColumn("total_revenue", F.when(F.col("customer_id") % 5 > 0, F.col("total_revenue"))).withColumn(
        "country", F.when(F.col("customer_id") % 7 > 0, F.col("country")))
    model = ML.train(holes.where("split = 'train'"), SMALL)
    scored = ML.score(model, holes)
    assert scored.count() == planted.count() and scored.where("isnan(churn_probability)").count() == 0
    same = ML.score(model, holes.na.fill(0.0)).withColumnRenamed("churn_probability", "p")
    assert scored.join(same, "customer_id").where("churn_probability <> p").count() == 0


def test_raw_tables_are_read_once_per_fit(spark, planted, tmp_path):
    """Weights, encoder, scaler and forest read the written rows: the plan of the fit's input holds no source scan."""
    source = str(tmp_path / "features")
    planted.write.parquet(source)
    data = ML.prepare_training(spark.read.parquet(source).where("split = 'train'"), params=SMALL)
    plan = data._jdf.queryExecution().executedPlan().toString()
    assert source not in plan and "class_weight" in data.columns


def test_every_string_feature_is_encoded(spark):
    df = spark.createDataFrame([(1, 0, "Pro", "New", 3)], "customer_id long, churned int, plan_type string, "
                                                          "customer_lifecycle_stage string, total_tickets int")
    assert ML.feature_columns(df) == (["total_tickets"], ["plan_type", "customer_lifecycle_stage"])


def test_artifact_round_trip(spark, planted):
    path = TB.scratch_path(spark, "test-artifact")
    model = ML.train(planted.where("split = 'train'"), SMALL)
    cm = spark.createDataFrame([(0, 1, 5)], "label int, prediction int, count long")
    ML.save_model(model, path, metrics={"auc": 0.75}, params=SMALL, training_date="d", tables={"confusion_matrix": cm})
    kept = ML.load_artifact(spark, path)
    assert kept["metrics"] == {"auc": 0.75} and kept["params"] == SMALL and kept["training_date"] == "d"
    assert kept["tables"]["confusion_matrix"].collect() == cm.collect()


def test_stream_and_batch_share_the_store(spark, planted):
    """Rows of another day, added in batch to a store a stream wrote, are all read back."""
    from keepwise.operators.scores import prediction_rows
    from keepwise.streaming.scoring import score_stream

    feats = planted.drop("split").where("customer_id < 100")
    model = ML.train(planted.where("split = 'train'"), SMALL)
    base = TB.scratch_path(spark, "test-shared-store")
    feats.write.parquet(f"{base}/in")
    score_stream(spark, model, f"{base}/in", f"{base}/store", f"{base}/ckpt", feats.schema,
                 as_of="2026-05-31 00:00:00").awaitTermination()
    TB.append_predictions(prediction_rows(ML.score(model, feats), as_of="2026-06-01 00:00:00"), f"{base}/store")
    assert TB.read_predictions(spark, f"{base}/store").count() == 200


def test_confusion_and_report(spark, labelled):
    rows = [tuple(r) for r in labelled.collect()]
    cm = {(r["label"], r["prediction"]): r["count"] for r in EVAL.confusion_matrix(labelled).collect()}
    assert sum(cm.values()) == len(rows)
    tp = sum(1 for _, y, p in rows if y == 1 and p >= 0.5)
    assert cm[(1, 1)] == tp
    rep = {r["class"]: r for r in EVAL.classification_report(labelled).collect()}
    prec1 = tp / (tp + cm[(0, 1)])
    rec1 = tp / (tp + cm[(1, 0)])
    assert rep["1"]["precision"] == pytest.approx(prec1)
    assert rep["1"]["f1_score"] == pytest.approx(2 * prec1 * rec1 / (prec1 + rec1))
    assert rep["weighted avg"]["support"] == len(rows)
    assert rep["accuracy"]["precision"] is None and rep["accuracy"]["support"] == len(rows)
    acc = EVAL.accuracy(labelled).first()["accuracy"]
    assert acc == pytest.approx((cm[(0, 0)] + cm[(1, 1)]) / len(rows))


def test_single_class_metrics_do_not_fail(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 0.7)], "label int, probability double")
    assert EVAL.roc_auc(df).first()["roc_auc"] is None
    rep = {r["class"]: r for r in EVAL.classification_report(df).collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["support"] == 0


def test_roc_curve_ends_at_one(spark, labelled):
    pts = EVAL.roc_curve(labelled).orderBy("threshold").collect()
    assert pts[0]["tpr"] == 1.0 and pts[0]["fpr"] == 1.0
    assert pts[-1]["threshold"] == float("inf") and (pts[-1]["fpr"], pts[-1]["tpr"]) == (0.0, 0.0)
    tprs = [p["tpr"] for p in pts]
    assert tprs == sorted(tprs, reverse=True)


def test_hash_split_is_repeatable_and_partition_free(spark):
    df = spark.range(5000).withColumnRenamed("id", "customer_id")
    a = P.hash_split(df).where("split = 'test'").select("customer_id")
    b = P.hash_split(df.repartition(13)).where("split = 'test'").select("customer_id")
    assert a.exceptAll(b).count() == 0
    share = a.count() / 5000
    assert 0.17 < share < 0.23


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(0,)] * 30 + [(1,)] * 10, "churned int")
    w = {r["churned"]: r["weight"] for r in P.class_weights(df).collect()}
    assert w == {0: 40 / 60, 1: 40 / 20}


def test_scaler_stats_are_the_scaler_s(spark, planted):
    """Merged moments are those a StandardScaler fits, and the fitted pipeline's scaler can be read back."""
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    cols = ["days_since_last_login", "total_revenue", "total_tickets"]
    rows = VectorAssembler(inputCols=cols, outputCol="v").transform(planted)
    fitted = StandardScaler(inputCol="v", outputCol="w", withMean=True).fit(rows)
    got = {r["feature"]: (r["mean"], r["std"]) for r in P.scaler_stats(planted, cols).collect()}
    for i, c in enumerate(cols):
        assert got[c] == (pytest.approx(fitted.mean[i], rel=1e-12), pytest.approx(fitted.std[i], rel=1e-12))
    spark = planted.sparkSession
    back = {r.feature: (r.mean, r.std) for r in ML.fitted_scaler(spark, ML.fit_scaler(planted)).collect()}
    assert all(back[c] == (pytest.approx(got[c][0], rel=1e-12), pytest.approx(got[c][1], rel=1e-12)) for c in cols)
    assert P.scaler_stats(planted.limit(1), cols).first()["std"] is None


def test_scaler_stats_keep_digits(spark):
    """Ratios such as 1/3 and values over 10^14 with a small spread: no rounding, no cancellation."""
    from fractions import Fraction

    xs, ys = [i / 3 for i in range(400)], [10**14 + i % 7 for i in range(400)]
    df = spark.createDataFrame(list(zip(xs, map(float, ys))), "x double, y double").repartition(7)
    got = {r.feature: r for r in P.scaler_stats(df, ["x", "y"]).collect()}
    for name, values in (("x", xs), ("y", ys)):
        exact = [Fraction(v) for v in values]
        mean = sum(exact) / 400
        var = sum((v - mean) ** 2 for v in exact) / 399
        assert got[name]["mean"] == pytest.approx(float(mean), rel=1e-14)
        assert got[name]["std"] == pytest.approx(float(var) ** 0.5, rel=1e-9)


@pytest.mark.parametrize("parts", [1, 5])
def test_corner_points_of_the_roc_curve(spark, parts):
    """Against the definition on all points in order, with equal area; scores outside [0, 1], null and one alone included."""
    rnd = random.Random(6)
    scores = [rnd.choice([0.1, 0.2, 0.25, 0.9999, 0.99991, 1.5, -2.0, float(i) / 40]) for i in range(60) for _ in range(3)]
    rows = [(int(rnd.random() < 0.5), p) for p in scores]
    df = spark.createDataFrame(rows, "label int, probability double").repartition(parts)
    key = lambda r: -r.threshold
    every = sorted(EVAL.roc_curve(df).collect(), key=key)
    thin = sorted(EVAL.roc_curve(df, drop_intermediate=True).collect(), key=key)
    steps = [(b.fpr - a.fpr, b.tpr - a.tpr) for a, b in zip(every, every[1:])]
    same = lambda a, b: all(abs(x - y) < 1e-12 for x, y in zip(a, b))
    want = [every[0], every[1]] + [p for i, p in enumerate(every[2:-1], 2) if not same(steps[i - 1], steps[i])] + [every[-1]]
    assert thin == want and len(thin) < len(every)
    area = lambda ps: sum((b.fpr - a.fpr) * (a.tpr + b.tpr) / 2 for a, b in zip(ps, ps[1:]))
    auc = EVAL.roc_auc(df).first()["roc_auc"]
    assert area(thin) == pytest.approx(auc, abs=1e-12) and area(every) == pytest.approx(auc, abs=1e-12)
    one = EVAL.roc_curve(df.where("probability = 1.5"), drop_intermediate=True).collect()
    assert sorted(r.threshold for r in one) == [1.5, float("inf")]
    assert EVAL.roc_curve(df.where("false")).collect() == []


def test_metrics_run_nothing_before_they_are_asked_for(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.25)], "label int, probability double")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy-metrics", "")
    EVAL.roc_auc(df), EVAL.roc_curve(df)
    assert list(tracker.getJobIdsForGroup("lazy-metrics")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.fixture(scope="module")
def planted(spark):
    """Label tied to one feature: churned iff days_since_last_login > 20."""
    rnd = random.Random(3)
    rows = []
    for i in range(600):
        d = rnd.randint(0, 40)
        rows.append((i, 1 if d > 20 else 0, d, rnd.random() * 100, rnd.randint(0, 5),
                     rnd.choice(["A", "B", "C"]), rnd.choice(["Small", "Large"]), "X"))
    return P.hash_split(spark.createDataFrame(
        rows, "customer_id long, churned int, days_since_last_login int, total_revenue double, "
              "total_tickets int, country string, company_size string, industry string"))


def test_planted_signal_is_learned(spark, planted):
    train = planted.where("split = 'train'")
    test = planted.where("split = 'test'")
    model = ML.train(train, SMALL)
    scored = ML.score(model, test, keep=("customer_id", "churned"))
    auc = EVAL.roc_auc(scored, label="churned", probability="churn_probability").first()["roc_auc"]
    assert auc > 0.9
    imp = ML.feature_importance(model, train).orderBy("rank").first()
    assert imp["feature"] == "days_since_last_login"


def test_save_load_same_scores(spark, planted):
    train = planted.where("split = 'train'")
    model = ML.train(train, SMALL)
    path = TB.scratch_path(spark, "test-model")
    ML.save_model(model, path, metrics={"auc": 1.0}, params=SMALL)
    loaded = ML.load_model(path)
    a = ML.score(model, planted).withColumnRenamed("churn_probability", "a")
    b = ML.score(loaded, planted).withColumnRenamed("churn_probability", "b")
    j = a.join(b, "customer_id")
    assert j.where("a <> b").count() == 0 and j.count() == planted.count()
    assert spark.read.parquet(f"{path}/info").count() == 1


def test_stream_equals_batch(spark, planted):
    from keepwise.streaming.scoring import score_stream

    feats = planted.drop("split")
    model = ML.train(planted.where("split = 'train'"), SMALL)
    base = TB.scratch_path(spark, "test-stream")
    feats.where("customer_id % 2 = 0").write.parquet(f"{base}/in")
    feats.where("customer_id % 2 = 1").write.mode("append").parquet(f"{base}/in")
    q = score_stream(spark, model, f"{base}/in", f"{base}/out", f"{base}/ckpt", feats.schema,
                     as_of="2026-05-31 00:00:00")
    q.awaitTermination()
    got = TB.read_predictions(spark, f"{base}/out").select("customer_id", "churn_probability")
    from keepwise.operators.scores import prediction_rows

    want = prediction_rows(ML.score(model, feats), as_of="2026-05-31 00:00:00").select(
        "customer_id", "churn_probability")
    assert got.count() == feats.count()
    assert got.exceptAll(want).count() == 0
    # a second run over the same files finds nothing new
    q2 = score_stream(spark, model, f"{base}/in", f"{base}/out", f"{base}/ckpt", feats.schema,
                      as_of="2026-05-31 00:00:00")
    q2.awaitTermination()
    assert TB.read_predictions(spark, f"{base}/out").count() == feats.count()


def test_end_to_end_jobs(spark):
    from keepwise.plans import jobs
    from keepwise.plans.queries import FIXTURE_CLOCKS, fixture_feature_tables

    sf = "/root/testdata/sf0.001"
    tables = fixture_feature_tables(spark, sf)
    base = TB.scratch_path(spark, "test-jobs")
    path, summary = jobs.extract_features(tables, FIXTURE_CLOCKS, f"{base}/raw")
    assert path.endswith("customer_data_20010201")
    s = summary.first()
    assert s["total_features"] == 32 and s["total_customers"] > 0
    feats = TB.read_csv(spark, path, ML_schema(spark, tables))
    out = jobs.train_and_evaluate(feats, f"{base}/model", SMALL, folds=0)
    assert out["confusion_matrix"].agg(F.sum("count")).first()[0] == out["accuracy"].first()["n"]
    report = jobs.daily_scoring(spark, tables, f"{base}/model", f"{base}/store", "2001-02-01 00:00:00",
                                clocks=FIXTURE_CLOCKS)
    assert report.where("risk_tier <> 'High Risk'").count() == 0
    assert TB.read_predictions(spark, f"{base}/store").count() == s["total_customers"]


def ML_schema(spark, tables):
    from keepwise.operators import features as FT
    from keepwise.plans.queries import FIXTURE_CLOCKS

    return FT.build_features(tables, FIXTURE_CLOCKS).schema


def test_stream_restart_scores_each_file_once(spark, planted):
    import time

    from keepwise.streaming.scoring import score_stream

    feats = planted.drop("split")
    model = ML.train(planted.where("split = 'train'"), SMALL)
    base = TB.scratch_path(spark, "test-stream-restart")
    feats.repartition(3, "customer_id").write.parquet(f"{base}/in")  # three files
    args = (spark, model, f"{base}/in", f"{base}/out", f"{base}/ckpt", feats.schema)
    # first run: one file per micro-batch on a slow trigger, stopped after the first batch
    q = score_stream(*args, as_of="2026-05-31 00:00:00", available_now=False, max_files_per_trigger=1)
    deadline = time.time() + 120
    while not q.recentProgress and time.time() < deadline:
        time.sleep(0.5)
    q.stop()
    first = TB.read_predictions(spark, f"{base}/out").count()
    assert 0 < first < feats.count()
    # restart from the checkpoint: the remaining files, and only those
    q2 = score_stream(*args, as_of="2026-05-31 00:00:00", max_files_per_trigger=1)
    q2.awaitTermination()
    out = TB.read_predictions(spark, f"{base}/out")
    assert out.count() == feats.count()
    assert out.select("customer_id").distinct().count() == feats.count()


def test_seeded_forest_is_repeatable(spark, planted):
    train = planted.where("split = 'train'")
    # same rows arriving in a different partitioning must give the same model
    a = ML.score(ML.train(train, SMALL), planted).select("customer_id", F.col("churn_probability").alias("a"))
    b = ML.score(ML.train(train.repartition(7), SMALL), planted).select(
        "customer_id", F.col("churn_probability").alias("b"))
    j = a.join(b, "customer_id")
    assert j.count() == planted.count() and j.where("a <> b").count() == 0


@pytest.mark.parametrize("key", ["train_forest", "cross_validated_auc", "score_batch", "model_save_load", "feature_importance",
                                 "stream_scoring", "daily_scoring"])
def test_model_queries_fit_the_reference_forest(spark, monkeypatch, key):
    from keepwise.plans import analytics as A

    from .conftest import SF_SMALL

    class Fitted(Exception):
        pass

    def fit(df, params=C.ForestParams(), **kwargs):
        raise Fitted(params.num_trees, params.max_depth)

    monkeypatch.setattr(ML, "train", fit)
    monkeypatch.setattr(ML, "cross_validate", fit)
    with pytest.raises(Fitted) as seen:
        A.QUERIES[key](spark, SF_SMALL)
    assert seen.value.args == (200, 15)
