from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from keepwise.operators.scores import latest_prediction
from keepwise.sources import latest as L
from keepwise.sources import tables as TB


def run_rows(spark, day, customers, p, hour=8):
    at = dt.datetime(2026, 1, day, hour)
    return spark.createDataFrame(
        [(f"{c}-{day}-{hour}-{p}", c, dt.date(2026, 1, day), Decimal(p), "High Risk", "v1", at) for c in customers],
        TB.SCHEMAS["churn_predictions"])


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_five_runs_one_late_one_repeated(spark):
    """After every run the table is what the whole store gives."""
    base = TB.scratch_path(spark, "latest-test")
    store, path = f"{base}/store", f"{base}/table"
    runs = [("r1", 1, range(20), "0.1", 8), ("r3", 3, range(5, 15), "0.3", 8), ("r2", 2, range(30), "0.2", 8),  # r2 is late
            ("r4", 4, range(0, 10), "0.4", 9), ("r3", 3, range(12, 18), "0.9", 10),  # r3 again, other customers
            ("r4", 4, range(0, 3), "0.5", 7)]  # r4 again: 3 .. 9 go back to their history
    for run, day, customers, p, hour in runs:
        TB.append_predictions(run_rows(spark, day, customers, p, hour), store, run_id=run)
        L.update_latest(spark, path, store, run)
        want = rows_of(latest_prediction(TB.read_predictions(spark, store)).select(*TB.SCHEMAS["churn_predictions"].names))
        assert rows_of(L.read_latest(spark, path)) == want
        for day_seen in (1, 2, 3):
            clock = dt.datetime(2026, 1, day_seen, 12)
            got = L.read_latest(spark, path, clock, store)
            assert rows_of(got) == rows_of(latest_prediction(TB.read_predictions(spark, store), as_of=clock).select(*got.columns))
    assert len(L.versions(spark, path)) == L.KEEP_VERSIONS


def test_an_unfinished_version_is_not_read(spark):
    base = TB.scratch_path(spark, "latest-test")
    store, path = f"{base}/store", f"{base}/table"
    with pytest.raises(FileNotFoundError):
        L.read_latest(spark, path)
    TB.append_predictions(run_rows(spark, 1, range(3), "0.1"), store, run_id="a")
    assert L.update_latest(spark, path, store, "a") == 0
    fs, at = L._folder(spark, f"{path}/v1")
    fs.mkdirs(at)  # a writer that died
    assert L.versions(spark, path) == [0] and len(rows_of(L.read_latest(spark, path))) == 3
    TB.append_predictions(run_rows(spark, 2, range(2), "0.2"), store, run_id="b")
    assert L.update_latest(spark, path, store, "b") == 1 and L.versions(spark, path) == [0, 1]
    with pytest.raises(ValueError):
        L.read_latest(spark, path, dt.datetime(2026, 1, 1))
