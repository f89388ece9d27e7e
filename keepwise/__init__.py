"""keepwise: customer-retention analytics as Spark DataFrame operators.

Feature extraction, churn scoring, prediction history and retention reports,
expressed with the DataFrame API so Catalyst plans the joins, aggregations and
scans. Every operator takes and returns DataFrames; clocks are arguments.

The most used operators are importable from the package root::

    from keepwise import build_features, high_risk_report, train, score
"""

__version__ = "0.1.0"

_EXPORTS = {
    "build_session": "keepwise.session",
    "size_shuffle_partitions": "keepwise.session",
    "load_tables": "keepwise.sources.tables",
    "append_predictions": "keepwise.sources.tables",
    "read_predictions": "keepwise.sources.tables",
    "customer_base": "keepwise.operators.features",
    "usage_metrics": "keepwise.operators.features",
    "financial_metrics": "keepwise.operators.features",
    "support_metrics": "keepwise.operators.features",
    "marketing_metrics": "keepwise.operators.features",
    "activity_rollup": "keepwise.operators.features",
    "build_features": "keepwise.operators.features",
    "Clocks": "keepwise.operators.features",
    "prediction_rows": "keepwise.operators.scores",
    "latest_prediction": "keepwise.operators.scores",
    "orphan_predictions": "keepwise.operators.scores",
    "high_risk_report": "keepwise.operators.reports",
    "indicator_lift": "keepwise.operators.reports",
    "tier_segments": "keepwise.operators.reports",
    "recommended_action": "keepwise.operators.reports",
    "revenue_at_risk": "keepwise.operators.reports",
    "feature_adoption_share": "keepwise.operators.reports",
    "extraction_summary": "keepwise.operators.reports",
    "hash_split": "keepwise.ml.prep",
    "class_weights": "keepwise.ml.prep",
    "train": "keepwise.ml.train",
    "score": "keepwise.ml.train",
    "cross_validate": "keepwise.ml.train",
    "feature_importance": "keepwise.ml.train",
    "roc_auc": "keepwise.ml.evaluate",
    "roc_curve": "keepwise.ml.evaluate",
    "confusion_matrix": "keepwise.ml.evaluate",
    "classification_report": "keepwise.ml.evaluate",
    "score_stream": "keepwise.streaming.scoring",
    "register_views": "keepwise.plans.views",
}
__all__ = sorted(_EXPORTS)


def __getattr__(name):
    """Import on first use, so ``import keepwise`` stays light."""
    if name in _EXPORTS:
        import importlib

        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'keepwise' has no attribute {name!r}")
