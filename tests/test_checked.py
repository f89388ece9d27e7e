from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from keepwise.sources import checked as CK
from keepwise.sources import tables as TB

SCHEMA = TB.SCHEMAS["churn_predictions"]


def batch(spark, rows):
    """(prediction_id, customer_id[, hour]) as prediction rows."""
    return spark.createDataFrame([(r[0], r[1], dt.date(2026, 1, 5), Decimal("0.5"), "Medium Risk", "v1",
                                   dt.datetime(2026, 1, 5, r[2] if len(r) > 2 else 8)) for r in rows], SCHEMA)


@pytest.mark.parametrize("bits", [CK.MAX_BITS, 8])
def test_stored_and_refused(spark, monkeypatch, bits):
    """Exact whatever the filter's size; repeated runs replace their own rows."""
    monkeypatch.setattr(CK, "MAX_BITS", bits)
    monkeypatch.setattr(CK, "_PAGE", 32_768)
    base = TB.scratch_path(spark, "checked-test")
    customers = spark.range(0, 5000).withColumnRenamed("id", "customer_id").repartition(3)
    # a third of the batch is one customer
    first = batch(spark, [(f"a{i}", 7) for i in range(100)] + [(f"b{i}", i) for i in range(4900, 5100)] + [("n", None), ("a5", 8, 9)])
    for _ in range(2):
        CK.append_checked(spark, first.repartition(4), customers, f"{base}/store", f"{base}/bad", "one")
    kept = {r.prediction_id: r.customer_id for r in TB.read_predictions(spark, f"{base}/store").collect()}
    assert kept == {f"a{i}": 7 for i in range(100)} | {f"b{i}": i for i in range(4900, 5000)}
    bad = sorted((r.prediction_id, r.reason) for r in CK.read_quarantine(spark, f"{base}/bad").collect())
    assert bad == sorted([(f"b{i}", "unknown customer") for i in range(5000, 5100)] + [("n", "no customer"), ("a5", "repeated id")])
    CK.append_checked(spark, batch(spark, [("a1", 7), ("c1", 1)]), customers, f"{base}/store", f"{base}/bad", "two")
    assert TB.read_predictions(spark, f"{base}/store").count() == 201
    assert [(r.prediction_id, r.reason) for r in CK.read_quarantine(spark, f"{base}/bad").where("run_id = 'two'").collect()] == [
        ("a1", "stored before")]
    CK.append_checked(spark, batch(spark, []), customers, f"{base}/store", f"{base}/bad", "empty")
    assert TB.read_predictions(spark, f"{base}/store").count() == 201


def test_the_filter_passes_all_it_holds_and_few_others(spark):
    ids = spark.range(0, 30_000, 3).withColumnRenamed("id", "k")
    pages = 10_000 * CK.BITS_PER_ID // 32_768 + 1
    passed = CK.may_hold(spark.range(0, 90_000).withColumnRenamed("id", "k"), "k", CK.bloom_pages(ids, "k", pages), pages)
    got = {r.k for r in passed.collect()}
    assert {r.k for r in ids.collect()} <= got and len(got) < 10_000 + 0.03 * 80_000
