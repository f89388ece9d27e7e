from __future__ import annotations

import datetime as dt

import pytest
from keepwise import config as C
from keepwise.ml import train as ML
from keepwise.operators import features as FT
from keepwise.sources import layout
from keepwise.sources import tables as TB
from keepwise.streaming.keyed import score_stream_daily
from pyspark.sql import functions as F


def test_merge_of_bucketed_sets_has_no_exchange(spark):
    """Sets written in equal buckets merge without any shuffle or broadcast; the rows are those of the plain merge."""
    base = spark.range(200).select(F.col("id").alias("customer_id"), (F.col("id") * 2).alias("a"))
    sets = {n: spark.range(0, 200, step).select(F.col("id").alias("customer_id"), (F.col("id") + step).alias(n))
            for n, step in (("b", 2), ("c", 3), ("d", 5))}
    kept = layout.bucketed(spark, {"base": base, **sets}, buckets=4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = FT.merge_feature_sets(*kept.values())
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3
        grouped = kept["base"].groupBy("customer_id").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in grouped
        want = FT.merge_feature_sets(base, *sets.values())
        assert sorted(map(tuple, merged.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, int(i % 3 == 0), i % 3 + (i % 7) / 10) for i in range(300)]
    return ML.train(spark.createDataFrame(rows, "customer_id long, churned int, x double"), C.ForestParams(num_trees=5, max_depth=3))


def test_one_prediction_per_customer_and_day(spark, model):
    """Repetitions in one batch, in later batches and after a restart; a late day; days behind the watermark; odd rows."""
    base = TB.scratch_path(spark, "keyed-test")
    schema = "customer_id long, x double, feature_time timestamp"
    noon = dt.datetime(2026, 3, 1, 12)

    def arrive(*rows):
        spark.createDataFrame([(c, float(c % 3), noon + dt.timedelta(days=d, hours=h)) for c, d, h in rows], schema).write.mode(
            "append").parquet(f"{base}/in")
        score_stream_daily(spark, model, f"{base}/in", f"{base}/out", f"{base}/ckpt",
                           spark.read.schema(schema).parquet(f"{base}/in").schema).awaitTermination()
        got = [(r.customer_id, r.prediction_date.day) for r in TB.read_predictions(spark, f"{base}/out").collect()]
        assert len(got) == len(set(got))
        return set(got)

    assert arrive((1, 0, 0), (1, 0, 3), (2, 0, 0), (2, 0, 0)) == {(1, 1), (2, 1)}
    assert arrive((1, 0, 5), (2, 0, 0), (1, 1, 0)) == {(1, 1), (2, 1), (1, 2)}          # repeated after a restart, next day
    assert arrive((3, 0, 0), (1, 1, 1), (2, 2, 0)) == {(1, 1), (2, 1), (1, 2), (3, 1), (2, 3)}  # a late customer
    after = arrive((1, 9, 0))                                                             # the watermark passes the first days
    assert after == arrive((4, 0, 0), (1, 0, 0), (1, 9, 2))                               # refused: told apart from repeats no more
    rows = TB.read_predictions(spark, f"{base}/out").collect()
    assert {r.risk_tier for r in rows if r.customer_id == 3} == {"High Risk"} and {r.risk_tier for r in rows if r.customer_id == 1} == {"Low Risk"}
