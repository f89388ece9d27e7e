"""The operators as Spark SQL views, for users who write SQL.

``register_views(spark, tables, as_of)`` creates temporary views of the
business tables and of every feature set and report, evaluated at the
clock(s) given, so the reference's queries can be written as
``spark.sql(...)`` over names they already know (``customers``,
``usage_metrics``, ``support_metrics``, ``latest_predictions``,
``high_risk_report``, ...). Views are lazy: nothing runs until a query
reads them, and Catalyst plans the SQL together with the view bodies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import features as FT
from ..operators import reports as R
from ..operators import scores as S


def register_views(spark: SparkSession, tables: dict[str, DataFrame], as_of, predictions: DataFrame | None = None,
                   profile: str = FT.FULL, with_rank: bool = False) -> list[str]:
    """Register the views and return their names.

    ``as_of`` is a clock or a :class:`features.Clocks`. ``predictions`` (the
    prediction store) enables ``latest_predictions`` and ``high_risk_report``;
    the report's rank column is computed only with ``with_rank=True`` (it
    materialises a checkpoint), otherwise order with ``ORDER BY``.
    """
    clocks = as_of if isinstance(as_of, FT.Clocks) else FT.Clocks.single(as_of)
    views: dict[str, DataFrame] = dict(tables)
    views["customer_base"] = FT.customer_base(tables["customers"], clocks.customers, profile)
    views["usage_metrics"] = FT.usage_metrics(tables["user_activity"], clocks.activity, profile)
    views["financial_metrics"] = FT.financial_metrics(tables["invoices"], clocks.invoices, profile)
    views["support_metrics"] = FT.support_metrics(tables["support_tickets"], clocks.tickets, profile)
    views["marketing_metrics"] = FT.marketing_metrics(tables["marketing_engagement"], clocks.marketing, profile)
    views["activity_rollup"] = FT.activity_rollup(tables["user_activity"], clocks.activity)
    views["customer_features"] = FT.build_features(tables, clocks, FT.CORE)
    if predictions is not None:
        views["churn_predictions"] = predictions
        views["latest_predictions"] = S.latest_prediction(predictions, as_of=clocks.customers)
        full = {
            "usage": FT.usage_metrics(tables["user_activity"], clocks.activity, FT.FULL),
            "financial": FT.financial_metrics(tables["invoices"], clocks.invoices, FT.FULL),
            "support": FT.support_metrics(tables["support_tickets"], clocks.tickets, FT.FULL),
        }
        report = R.high_risk_report(tables["customers"], predictions, full["usage"], full["financial"],
                                    full["support"], clocks.customers)
        views["high_risk_report"] = R.rank_report(report) if with_rank else report
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
