"""The command line runs the three steps on a folder of business tables."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from keepwise.sources import fixtures as fx
from keepwise.sources import tables as TB

from .conftest import ROOT, SF_SMALL


def run_cli(*args: str) -> dict:
    env = dict(os.environ, PYTHONPATH=ROOT)
    out = subprocess.run([sys.executable, "-m", "keepwise", "--master", "local[2]", *args],
                         capture_output=True, text=True, env=env, timeout=900, cwd=ROOT)
    assert out.returncode == 0, out.stderr[-3000:]
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_cli_extract_train_score(spark):
    base = TB.scratch_path(spark, "test-cli").replace("file:", "")
    src = f"{base}/tables"
    for name, df in fx.fixture_tables(spark, SF_SMALL).items():
        if name in TB.BASE_TABLES:
            df.write.parquet(f"{src}/{name}")
    ex = run_cli("extract", "--src", src, "--out", f"{base}/raw", "--as-of", "2001-02-01")
    assert ex["path"].endswith("customer_data_20010201") and ex["total_features"] == 32
    tr = run_cli("train", "--features", ex["path"], "--model", f"{base}/model", "--folds", "0",
                 "--trees", "10", "--depth", "4")
    assert 0.0 <= tr["accuracy"] <= 1.0
    sc = run_cli("score", "--src", src, "--model", f"{base}/model", "--store", f"{base}/store",
                 "--report", f"{base}/report", "--as-of", "2001-02-01")
    report = spark.read.parquet(sc["report"])
    assert "report_rank" in report.columns
    assert TB.read_predictions(spark, f"{base}/store").count() == ex["total_customers"]
