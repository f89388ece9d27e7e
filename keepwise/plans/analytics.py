"""Registered queries for scores, reports, evaluation, the model and the
stream (sections 2.1, 2.5, 2.6, 2.9 .. 2.12)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import config as C
from ..functions import dates
from ..functions import exprs as X
from ..ml import evaluate as EVAL
from ..ml import prep as P
from ..ml import train as ML
from ..operators import features as FT
from ..operators import ordering as ORD
from ..operators import reports as R
from ..operators import scores as S
from ..sources import fixtures as fx
from ..sources import tables as TB
from ..streaming.scoring import score_stream
from . import oracle as O
from .oracle_tables import AS_OF_EVENTS_SQL as EV
from .oracle_tables import AS_OF_ORDERS_SQL as OR
from .oracle_tables import with_tables

AS_OF_O = fx.AS_OF_ORDERS
AS_OF_E = fx.AS_OF_EVENTS
QUERIES: dict = {}
ORACLE: dict = {}
TOP_N = 100
# Fixture thresholds for the lift report (README's own values leave empty
# groups on the fixture data, see SURVEY 2.11).
FIXTURE_LIFT = C.LiftThresholds(inactive_days=16, tickets_per_month=0.5, feature_share=0.49, late_payments=1)


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _latest(spark, d):
    return S.latest_prediction(fx.churn_predictions(spark, d), as_of=AS_OF_O)


LATEST_SQL = with_tables("churn_predictions", extra=[O.NEWEST_CTE])

# --- 2.5 / 2.6 / 2.3 --------------------------------------------------------------


@register("latest_prediction", LATEST_SQL + """SELECT customer_id, prediction_id, prediction_date,
    CAST(churn_probability AS DOUBLE) AS churn_probability, risk_tier FROM newest""")
def latest_prediction(spark, d):
    return _latest(spark, d).select("customer_id", "prediction_id", "prediction_date",
                                    F.col("churn_probability").cast("double").alias("churn_probability"),
                                    "risk_tier")


@register("orphan_predictions", with_tables("customers", "churn_predictions") + f"""SELECT p.prediction_id,
    p.customer_id, p.prediction_date, CAST(p.churn_probability AS DOUBLE) AS churn_probability, p.risk_tier
    FROM churn_predictions p
    WHERE NOT EXISTS (SELECT 1 FROM ({O.customer_base_sql('full')}) c WHERE c.customer_id = p.customer_id)""")
def orphan_predictions(spark, d):
    base = FT.customer_base(fx.customers(spark, d), AS_OF_O, FT.FULL)
    return S.orphan_predictions(fx.churn_predictions(spark, d), base).select(
        "prediction_id", "customer_id", "prediction_date",
        F.col("churn_probability").cast("double").alias("churn_probability"), "risk_tier")


@register("top_risk_customers", LATEST_SQL + f"""SELECT customer_id, CAST(churn_probability AS DOUBLE) AS
    churn_probability, risk_tier, ROW_NUMBER() OVER (ORDER BY churn_probability DESC, customer_id ASC) AS risk_rank
    FROM newest ORDER BY churn_probability DESC, customer_id ASC LIMIT {TOP_N}""")
def top_risk_customers(spark, d):
    lp = _latest(spark, d).select("customer_id", F.col("churn_probability").cast("double").alias("churn_probability"),
                                  "risk_tier")
    return ORD.top_n(lp, [F.col("churn_probability").desc()], ["customer_id"], TOP_N, "risk_rank")


# --- 2.1 S4 / 2.9 Q7: prediction store ----------------------------------------------------

_STORE_H = "('0x' || substr(md5(CAST(customer_id AS VARCHAR) || ':s'), 1, 8))::BIGINT"
_STORE_P = f"CAST({_STORE_H} % 10001 AS DOUBLE) / 10000.0"


@register("prediction_store", with_tables("customers") + f"""SELECT
    md5(CAST(customer_id AS VARCHAR) || '|' || CAST(CAST({OR} AS DATE) AS VARCHAR) || '|v1.0') AS prediction_id,
    customer_id, CAST({OR} AS DATE) AS prediction_date,
    CAST(CAST({_STORE_P} AS DECIMAL(5,4)) AS DOUBLE) AS churn_probability,
    CASE WHEN {_STORE_P} >= 0.7 THEN 'High Risk' WHEN {_STORE_P} >= 0.4 THEN 'Medium Risk' ELSE 'Low Risk' END
        AS risk_tier,
    'v1.0' AS model_version, {OR} AS created_at
    FROM customers""")
def prediction_store(spark, d):
    """Score every customer at the clock, append the rows to a fresh store and
    read the store back."""
    scored = fx.customers(spark, d).select(
        "customer_id", fx.fixture_probability(F.col("customer_id"), ":s").alias("churn_probability"))
    rows = S.prediction_rows(scored, as_of=AS_OF_O, created_at=AS_OF_O)
    path = TB.append_predictions(rows, TB.scratch_path(spark, "store"))
    return TB.read_predictions(spark, path).withColumn(
        "churn_probability", F.col("churn_probability").cast("double"))


# --- 2.4 A11 and 2.11 reports ----------------------------------------------------------------

def _merged(spark, d):
    from .queries import merged_features

    return merged_features(spark, d)


_MERGED_WITH = with_tables("customers", "user_activity", "invoices", "support_tickets", "marketing_engagement",
                           extra=O.merged_ctes("core") + [f"merged AS ({O.merged_select()})"])


@register("extraction_summary", _MERGED_WITH + f"""SELECT COUNT(*) AS total_customers,
    CAST(SUM(churned) AS BIGINT) AS churned_customers, ({O.mean('churned')}) * 100.0 AS churn_rate_pct,
    CAST({len(O.MERGED_ORDER_CORE)} AS BIGINT) AS total_features FROM merged""")
def extraction_summary(spark, d):
    return R.extraction_summary(_merged(spark, d))


def _scored_with_value(spark, d):
    lp = _latest(spark, d).select("customer_id", "churn_probability", "risk_tier")
    fin = FT.financial_metrics(fx.invoices(spark, d), AS_OF_O, FT.FULL).select(
        "customer_id", F.col("total_revenue").alias("value"))
    status = fx.customers(spark, d).select("customer_id", "account_status")
    return (lp.join(fin, "customer_id", "left").join(status, "customer_id", "left")
            .withColumn("value", F.coalesce(F.col("value"), F.lit(0.0))))


_SCORED_WITH = with_tables("customers", "invoices", "churn_predictions",
                           extra=[O.NEWEST_CTE] + [f"billing AS ({O.financial_sql('full')})",
                              """scored AS (SELECT lp.customer_id, lp.churn_probability, lp.risk_tier,
        COALESCE(f.total_revenue, 0.0) AS value, c.account_status
        FROM newest lp LEFT JOIN billing f ON lp.customer_id = f.customer_id
        LEFT JOIN customers c ON lp.customer_id = c.customer_id)"""])


@register("tier_segments", _SCORED_WITH + f"""SELECT risk_tier, COUNT(*) AS customers,
    CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value,
    {O.mean('churn_probability')} AS avg_probability FROM scored GROUP BY risk_tier""")
def tier_segments(spark, d):
    return R.tier_segments(_scored_with_value(spark, d), "value")


def _case(column: str, values) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values) + " END"


@register("recommended_action", _SCORED_WITH + f"""SELECT customer_id, risk_tier,
    {_case('risk_tier', [(t, a) for t, a, _ in C.TIER_ACTIONS])} AS action,
    {_case('risk_tier', [(t, x) for t, _, x in C.TIER_ACTIONS])} AS action_detail FROM scored""")
def recommended_action(spark, d):
    return R.recommended_action(_scored_with_value(spark, d).select("customer_id", "risk_tier"))


@register("revenue_at_risk", _SCORED_WITH + """SELECT high_risk_customers, revenue_at_risk, saved_customers,
    save_rate, revenue_at_risk * save_rate AS net_revenue_protected
    FROM (SELECT *, CASE WHEN high_risk_customers > 0
                         THEN CAST(saved_customers AS DOUBLE) / CAST(high_risk_customers AS DOUBLE) ELSE 0.0 END
                    AS save_rate
          FROM (SELECT CAST(SUM(CASE WHEN risk_tier = 'High Risk' THEN 1 ELSE 0 END) AS BIGINT) AS high_risk_customers,
                       CAST(COALESCE(SUM(CASE WHEN risk_tier = 'High Risk' THEN CAST(value AS DECIMAL(18,2)) END), 0)
                            AS DOUBLE) AS revenue_at_risk,
                       CAST(SUM(CASE WHEN risk_tier = 'High Risk' AND account_status = 'Active' THEN 1 ELSE 0 END)
                            AS BIGINT) AS saved_customers
                FROM scored) a) b""")
def revenue_at_risk(spark, d):
    return R.revenue_at_risk(_scored_with_value(spark, d), "value", "account_status")


_AVAILABLE_SQL = f"""(SELECT COUNT(DISTINCT feature_id) FROM user_activity
     WHERE login_date >= {O.months_before(EV, 6)} AND login_date < {EV})"""


@register("feature_adoption_share", with_tables("user_activity") + f"""SELECT customer_id, unique_features_used,
    features_available, {O.ratio('unique_features_used', 'features_available')} AS adoption_share
    FROM (SELECT customer_id, COUNT(DISTINCT feature_id) AS unique_features_used, {_AVAILABLE_SQL} AS features_available
          FROM user_activity WHERE login_date >= {O.months_before(EV, 6)} AND login_date < {EV}
          GROUP BY customer_id) t""")
def feature_adoption_share(spark, d):
    return R.feature_adoption_share(fx.user_activity(spark, d), AS_OF_E)


@register("activity_rollup", with_tables("user_activity") + f"""SELECT customer_id,
    {O.days('MAX(login_date)', EV)} AS days_since_login, COUNT(DISTINCT feature_id) AS features_used,
    {O.mean('session_duration_minutes')} AS avg_session_time
    FROM user_activity WHERE login_date >= {O.months_before(EV, 6)} AND login_date < {EV} GROUP BY customer_id""")
def activity_rollup(spark, d):
    return FT.activity_rollup(fx.user_activity(spark, d), AS_OF_E)


def _lift_sql(t: C.LiftThresholds = FIXTURE_LIFT) -> str:
    flags = {
        "inactive": f"days_since_last_login > {float(t.inactive_days)}",
        "support_tickets": f"CAST(total_tickets AS DOUBLE) / {float(t.ticket_window_months)} > {float(t.tickets_per_month)}",
        "low_adoption": f"{O.ratio('unique_features_used', 'features_available')} < {float(t.feature_share)}",
        "late_payment": f"late_payments >= {int(t.late_payments)}",
    }
    parts = []
    for name, cond in flags.items():
        c = f"COALESCE({cond}, FALSE)"
        parts.append(f"""SELECT '{name}' AS indicator,
            CAST(SUM(CASE WHEN {c} THEN 1 ELSE 0 END) AS BIGINT) AS n1,
            CAST(SUM(CASE WHEN {c} AND churned = 1 THEN 1 ELSE 0 END) AS BIGINT) AS c1,
            CAST(SUM(CASE WHEN NOT {c} THEN 1 ELSE 0 END) AS BIGINT) AS n0,
            CAST(SUM(CASE WHEN NOT {c} AND churned = 1 THEN 1 ELSE 0 END) AS BIGINT) AS c0
            FROM merged_a""")
    body = "\nUNION ALL\n".join(parts)
    rate1 = "CASE WHEN n1 > 0 THEN CAST(c1 AS DOUBLE) / CAST(n1 AS DOUBLE) END"
    rate0 = "CASE WHEN n0 > 0 THEN CAST(c0 AS DOUBLE) / CAST(n0 AS DOUBLE) END"
    merged_a = f"merged_a AS (SELECT *, {_AVAILABLE_SQL} AS features_available FROM merged)"
    return (with_tables("customers", "user_activity", "invoices", "support_tickets", "marketing_engagement",
                        extra=O.merged_ctes("core") + [f"merged AS ({O.merged_select()})", merged_a])
            + f"""SELECT indicator, n1 AS flagged, {rate1} AS rate_flagged, {rate0} AS rate_other,
    CASE WHEN ({rate0}) > 0 THEN ({rate1}) / ({rate0}) END AS lift FROM ({body}) s""")


def _lift(spark, d, thresholds: C.LiftThresholds):
    available = R.features_available(R.features_used(fx.user_activity(spark, d), AS_OF_E))
    return R.indicator_lift(_merged(spark, d), available, thresholds)


@register("indicator_lift", _lift_sql())
def indicator_lift(spark, d):
    return _lift(spark, d, FIXTURE_LIFT)


@register("indicator_lift_readme", _lift_sql(C.LiftThresholds()))
def indicator_lift_readme(spark, d):
    """The README's own thresholds; on the fixture some groups are empty, so
    their lift is NULL rather than a division by zero."""
    return _lift(spark, d, C.LiftThresholds())


# --- 2.10 evaluation on the fixture scores ----------------------------------------------------

_LABELLED = with_tables("customers", "churn_predictions", extra=[O.NEWEST_CTE, """labelled AS (
    SELECT lp.customer_id, CASE WHEN c.account_status = 'Churned' THEN 1 ELSE 0 END AS label,
           CAST(('0x' || substr(md5(CAST(lp.customer_id AS VARCHAR) || ':e'), 1, 8))::BIGINT AS DOUBLE) / 4294967296.0
               AS probability
    FROM newest lp JOIN customers c ON lp.customer_id = c.customer_id)""",
    """counts AS (SELECT
        CAST(SUM(CASE WHEN label <> 1 AND NOT probability >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
        CAST(SUM(CASE WHEN label <> 1 AND probability >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
        CAST(SUM(CASE WHEN label = 1 AND NOT probability >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
        CAST(SUM(CASE WHEN label = 1 AND probability >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tp
        FROM labelled)""",
    """hist AS (SELECT probability AS bin,
        CAST(SUM(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
        CAST(SUM(CASE WHEN label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS neg FROM labelled GROUP BY 1)"""])


def _labelled(spark, d):
    return fx.scored_labels(spark, d)


@register("eval_accuracy", _LABELLED + """SELECT COUNT(*) AS n,
    CAST(SUM(CASE WHEN CAST(probability >= 0.5 AS INTEGER) = label THEN 1 ELSE 0 END) AS BIGINT) AS correct,
    CASE WHEN COUNT(*) > 0 THEN CAST(SUM(CASE WHEN CAST(probability >= 0.5 AS INTEGER) = label THEN 1 ELSE 0 END)
         AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) ELSE 0.0 END AS accuracy FROM labelled""")
def eval_accuracy(spark, d):
    return EVAL.accuracy(_labelled(spark, d))


@register("eval_auc", _LABELLED + """SELECT positives, negatives,
    CASE WHEN 2.0 * CAST(positives AS DOUBLE) * CAST(negatives AS DOUBLE) > 0
         THEN CAST(u2 AS DOUBLE) / (2.0 * CAST(positives AS DOUBLE) * CAST(negatives AS DOUBLE)) END AS roc_auc
    FROM (SELECT CAST(SUM(pos * (2 * neg_below + neg)) AS DECIMAL(38,0)) AS u2,
                 CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives
          FROM (SELECT *, COALESCE(SUM(neg) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                          AS neg_below FROM hist) h) t""")
def eval_auc(spark, d):
    return EVAL.roc_auc(_labelled(spark, d))


@register("confusion_matrix", _LABELLED + """SELECT 0 AS label, 0 AS prediction, tn AS count FROM counts
    UNION ALL SELECT 0, 1, fp FROM counts UNION ALL SELECT 1, 0, fn FROM counts UNION ALL SELECT 1, 1, tp FROM counts""")
def confusion_matrix(spark, d):
    return EVAL.confusion_matrix(_labelled(spark, d))


def _div(a, b):
    return f"CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) ELSE 0.0 END"


def _f1(p, r):
    return f"CASE WHEN ({p} + {r}) > 0 THEN (2.0 * {p} * {r}) / ({p} + {r}) ELSE 0.0 END"


def _wavg(a, b):
    return (f"CASE WHEN CAST(s0 + s1 AS DOUBLE) > 0 THEN ({a} * CAST(s0 AS DOUBLE) + {b} * CAST(s1 AS DOUBLE))"
            f" / CAST(s0 + s1 AS DOUBLE) ELSE 0.0 END")


@register("classification_report", _LABELLED + f""", m AS (SELECT {_div('tn', 'tn + fn')} AS p0,
        {_div('tn', 'tn + fp')} AS r0, {_div('tp', 'tp + fp')} AS p1, {_div('tp', 'tp + fn')} AS r1,
        tn + fp AS s0, tp + fn AS s1, tn, tp FROM counts),
    m2 AS (SELECT *, {_f1('p0', 'r0')} AS f0, {_f1('p1', 'r1')} AS f1 FROM m)
    SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, CAST(s0 AS BIGINT) AS support FROM m2
    UNION ALL SELECT '1', p1, r1, f1, CAST(s1 AS BIGINT) FROM m2
    UNION ALL SELECT 'macro avg', (p0 + p1) / 2.0, (r0 + r1) / 2.0, (f0 + f1) / 2.0, CAST(s0 + s1 AS BIGINT) FROM m2
    UNION ALL SELECT 'weighted avg', {_wavg('p0', 'p1')}, {_wavg('r0', 'r1')}, {_wavg('f0', 'f1')},
        CAST(s0 + s1 AS BIGINT) FROM m2
    UNION ALL SELECT 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
        CASE WHEN CAST(s0 + s1 AS DOUBLE) > 0 THEN CAST(tn + tp AS DOUBLE) / CAST(s0 + s1 AS DOUBLE) END,
        CAST(s0 + s1 AS BIGINT) FROM m2""")
def classification_report(spark, d):
    return EVAL.classification_report(_labelled(spark, d))


@register("roc_curve", _LABELLED + """SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
    FROM labelled HAVING COUNT(*) > 0
    UNION ALL
    SELECT bin AS threshold,
    CASE WHEN N > 0 THEN CAST(cum_neg AS DOUBLE) / CAST(N AS DOUBLE) ELSE 0.0 END AS fpr,
    CASE WHEN P > 0 THEN CAST(cum_pos AS DOUBLE) / CAST(P AS DOUBLE) ELSE 0.0 END AS tpr
    FROM (SELECT bin, SUM(pos) OVER (ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
                 SUM(neg) OVER (ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
                 SUM(pos) OVER () AS P, SUM(neg) OVER () AS N FROM hist) h""")
def roc_curve(spark, d):
    return EVAL.roc_curve(_labelled(spark, d))


@register("roc_curve_corners", _LABELLED + """SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
    FROM labelled HAVING COUNT(*) > 0
    UNION ALL
    SELECT bin AS threshold,
    CASE WHEN N > 0 THEN CAST(cum_neg AS DOUBLE) / CAST(N AS DOUBLE) ELSE 0.0 END AS fpr,
    CASE WHEN P > 0 THEN CAST(cum_pos AS DOUBLE) / CAST(P AS DOUBLE) ELSE 0.0 END AS tpr
    FROM (SELECT bin, pos, neg, SUM(pos) OVER (ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
                 SUM(neg) OVER (ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
                 LEAD(pos) OVER (ORDER BY bin DESC) AS pos_next, LEAD(neg) OVER (ORDER BY bin DESC) AS neg_next,
                 ROW_NUMBER() OVER (ORDER BY bin DESC) AS place, SUM(pos) OVER () AS P, SUM(neg) OVER () AS N FROM hist) h
    WHERE place = 1 OR pos_next IS NULL OR pos != pos_next OR neg != neg_next""")
def roc_curve_corners(spark, d):
    """The curve without the points it runs straight through."""
    return EVAL.roc_curve(_labelled(spark, d), drop_intermediate=True)


# --- 2.10 training-table preparation -----------------------------------------------------------

_SPLIT_SQL = (_MERGED_WITH.rstrip() + """,
split AS (SELECT *, CASE WHEN ('0x' || substr(md5(CAST(customer_id AS VARCHAR) || ':42'), 1, 8))::BIGINT
                          < 0.2 * 4294967296.0 THEN 'test' ELSE 'train' END AS split FROM merged)
""")


def _split(spark, d):
    return P.hash_split(_merged(spark, d), "customer_id", 0.2, 42)


@register("train_test_split", _SPLIT_SQL + "SELECT customer_id, churned, split FROM split")
def train_test_split(spark, d):
    return _split(spark, d).select("customer_id", "churned", "split")


@register("split_class_balance", _SPLIT_SQL + f"""SELECT split, COUNT(*) AS rows,
    CAST(SUM(churned) AS BIGINT) AS positives, {O.mean('churned')} AS positive_rate FROM split GROUP BY split""")
def split_class_balance(spark, d):
    return P.split_class_balance(_split(spark, d), "churned")


@register("class_weights", _SPLIT_SQL + """SELECT churned, n,
    CAST(total AS DOUBLE) / (CAST(k AS DOUBLE) * CAST(n AS DOUBLE)) AS weight
    FROM (SELECT churned, COUNT(*) AS n FROM split WHERE split = 'train' GROUP BY churned) a,
         (SELECT COUNT(*) AS total, COUNT(DISTINCT churned) AS k FROM split WHERE split = 'train') b""")
def class_weights(spark, d):
    return P.class_weights(_split(spark, d).where(F.col("split") == P.TRAIN), "churned")


_CODES = ("country", "company_size", "industry")


@register("encoded_features", _MERGED_WITH + ", coded AS (SELECT customer_id, " + ", ".join(
    f"DENSE_RANK() OVER (ORDER BY {c}) - 1 AS {c}_at" for c in _CODES) + " FROM merged) SELECT customer_id, " + ", ".join(
    f"CAST({c}_at AS DOUBLE) AS {c}__idx, [CAST(x = {c}_at AS INTEGER)::DOUBLE "
    f"FOR x IN range((SELECT COUNT(DISTINCT {c}) FROM merged))] AS {c}__hot" for c in _CODES) + " FROM coded")
def encoded_features(spark, d):
    """Index and one-hot vector per categorical column; the vector's last slot
    (values unseen in the fit, none here) is left out."""
    df = _merged(spark, d)
    _, cats = ML.feature_columns(df)
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    model = Pipeline(stages=ML.encode_stages(cats)).fit(df)
    hot = {c: vector_to_array(f"{c}__vec") for c in cats}
    return model.transform(df).select("customer_id", *[F.col(f"{c}__idx") for c in cats], *[
        F.slice(v, 1, F.size(v) - 1).alias(f"{c}__hot") for c, v in hot.items()])


def _scaler_cols(spark, d):
    num, _ = ML.feature_columns(_merged(spark, d))
    return num


SCALER_COLUMNS = [c for c, _ in O.MERGED_NUMERIC_CORE if c != "churned"]


def _digits(expr: str) -> str:
    """Ten significant digits: sums of doubles differ in the last ones by their order."""
    return f"CAST(printf('%.9e', {expr}) AS DOUBLE)"


def _moments(c: str) -> str:
    return (f"SELECT '{c}' AS feature, {_digits(f'AVG(CAST({c} AS DOUBLE))')} AS mean, "
            f"{_digits(f'STDDEV_SAMP(CAST({c} AS DOUBLE))')} AS std, TRUE AS moments_agree FROM split WHERE split = 'train'")


@register("scaler_stats", _SPLIT_SQL + "\nUNION ALL\n".join(map(_moments, SCALER_COLUMNS)))
def scaler_stats(spark, d):
    """Mean and deviation read from the scaler a fitted pipeline holds, against
    DuckDB's; ``moments_agree``: the merged moments of the training rows are the
    same to 1e-12."""
    train = ML.materialised(_split(spark, d).where(F.col("split") == P.TRAIN), "train")
    cols = _scaler_cols(spark, d)
    fitted = ML.fitted_scaler(spark, ML.fit_scaler(train)).where(F.col("feature").isin(cols))
    own = P.scaler_stats(train, cols).withColumnsRenamed({"mean": "own_mean", "std": "own_std"})

    def near(a, b):
        return F.abs(F.col(a) - F.col(b)) <= 1e-12 * (F.abs(F.col(a)) + 1e-300)

    return fitted.join(own, "feature").select(
        "feature", *[F.format_string("%.9e", F.col(c)).cast("double").alias(c) for c in ("mean", "std")],
        (near("mean", "own_mean") & near("std", "own_std")).alias("moments_agree"))


# --- 2.10 model: what must hold of any fit, computed from its real scores ------------------------

def _train_model(spark, d, params: C.ForestParams = C.ForestParams()):
    return ML.train(_split(spark, d).where(F.col("split") == P.TRAIN), params)


@register("train_forest", f"SELECT {C.ForestParams().num_trees}::BIGINT AS trees, TRUE AS depth_in_bounds")
def train_forest(spark, d):
    trees = _train_model(spark, d).stages[-1].trees
    rows = [(t.numNodes, t.depth) for t in trees]
    df = spark.createDataFrame(rows, "num_nodes int, depth int")
    return df.agg(F.count(F.lit(1)).alias("trees"), (F.max("depth") <= C.ForestParams().max_depth).alias("depth_in_bounds"))


@register("cross_validated_auc", "SELECT 'roc_auc' AS metric, 5 AS folds, TRUE AS mean_in_range, TRUE AS bounds_match")
def cross_validated_auc(spark, d):
    train = _split(spark, d).where(F.col("split") == P.TRAIN)
    cv = ML.cross_validate(train, folds=5)
    mid = (F.col("lower") + F.col("upper")) / 2
    return cv.select("metric", "folds", F.col("mean").between(0, 1).alias("mean_in_range"),
                     (F.abs(mid - F.col("mean")) < 1e-12).alias("bounds_match"))


@register("score_batch", _SPLIT_SQL + "SELECT customer_id, TRUE AS probability_in_range, TRUE AS tier_agrees, "
                                      "TRUE AS class_agrees FROM split WHERE split = 'test'")
def score_batch(spark, d):
    test = _split(spark, d).where(F.col("split") == P.TEST)
    scored = ML.score(_train_model(spark, d), test)
    p = F.col("churn_probability")
    # the class is the larger of two probabilities, the first one on a tie
    return scored.withColumn("risk_tier", X.risk_tier(p)).select(
        "customer_id", p.between(0, 1).alias("probability_in_range"), _tier_agrees(p, F.col("risk_tier")).alias("tier_agrees"),
        ((F.col("prediction") == 1) == (p > 0.5)).alias("class_agrees"))


def _tier_agrees(p, tier):
    return ((tier == C.HIGH_RISK) == (p >= C.HIGH_RISK_THRESHOLD)) & ((tier == C.LOW_RISK) == (p < C.MEDIUM_RISK_THRESHOLD))


@register("model_save_load", _MERGED_WITH + "SELECT customer_id, TRUE AS same, TRUE AS metrics_kept FROM merged")
def model_save_load(spark, d):
    """Every customer scored by the model and by its saved and loaded copy; a
    stored table comes back with it."""
    # the feature table is built once: the fit and both scorings read it
    data = ML.materialised(_merged(spark, d), "features")
    model = ML.train(P.hash_split(data, "customer_id", 0.2, 42).where(F.col("split") == P.TRAIN))
    path = TB.scratch_path(spark, "model")
    importance = ML.feature_importance(model, data)
    ML.save_model(model, path, metrics={"auc": 0.5}, params=C.ForestParams(), tables={"feature_importance": importance},
                  training_date=dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S"))
    kept = ML.load_artifact(spark, path)
    same = (kept["params"] == C.ForestParams() and kept["metrics"] == {"auc": 0.5}
            and sorted(kept["tables"]["feature_importance"].collect()) == sorted(importance.collect()))
    a = ML.score(model, data).select("customer_id", F.col("churn_probability").alias("p_before"))
    b = ML.score(kept["model"], data).select("customer_id", F.col("churn_probability").alias("p_after"))
    return a.join(b, "customer_id").select("customer_id", (F.col("p_before") == F.col("p_after")).alias("same"),
                                           F.lit(same).alias("metrics_kept"))


@register("feature_importance", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, TRUE AS sums_to_one" for c in [*SCALER_COLUMNS, *_CODES]))
def feature_importance(spark, d):
    data = _merged(spark, d)
    imp = ML.feature_importance(_train_model(spark, d), data)
    path = TB.write_csv(imp, TB.scratch_path(spark, "importance"))
    back = TB.read_csv(spark, path, imp.schema)
    total = back.agg(F.sum("importance").alias("total"))
    return R.attach_scalar(back, total).select("feature", (F.abs(F.col("total") - 1) < 1e-9).alias("sums_to_one"))


@register("stream_scoring", _MERGED_WITH + f"""SELECT customer_id,
    md5(CAST(customer_id AS VARCHAR) || '|' || CAST(CAST({OR} AS DATE) AS VARCHAR) || '|v1.0') AS prediction_id,
    CAST({OR} AS DATE) AS prediction_date, 'v1.0' AS model_version, TRUE AS equals_batch FROM merged""")
def stream_scoring(spark, d):
    """The whole feature table arrives as files; the stream scores them into
    the store, which must hold what scoring in batch gives."""
    data = ML.materialised(_merged(spark, d), "features")
    model = _train_model(spark, d)
    base = TB.scratch_path(spark, "stream")
    in_dir, out_dir, ckpt = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    data.repartition("customer_id").write.parquet(in_dir)
    q = score_stream(spark, model, in_dir, out_dir, ckpt, data.schema, as_of=AS_OF_O, max_files_per_trigger=100,
                     created_at=AS_OF_O)
    q.awaitTermination()
    batch = S.prediction_rows(ML.score(model, data), as_of=AS_OF_O, created_at=AS_OF_O).select(
        "prediction_id", F.struct("churn_probability", "risk_tier", "created_at").alias("want"))
    got = TB.read_predictions(spark, out_dir)
    return got.join(batch, "prediction_id", "left").select(
        "customer_id", "prediction_id", "prediction_date", "model_version",
        F.coalesce(F.struct("churn_probability", "risk_tier", "created_at") == F.col("want"), F.lit(False)).alias("equals_batch"))


@register("daily_scoring", _MERGED_WITH + f"""SELECT customer_id,
    CAST({OR} AS DATE) AS prediction_date, 'v1.0' AS model_version, TRUE AS tier_agrees, TRUE AS listed_if_risky
    FROM merged""")
def daily_scoring(spark, d):
    """The daily run over all customers of the base: every one is in the store
    with the tier of its probability, and in the report exactly if it is risky
    and active."""
    from . import jobs
    from .queries import FIXTURE_CLOCKS, fixture_feature_tables

    tables = fixture_feature_tables(spark, d)
    store = TB.scratch_path(spark, "daily")
    report = jobs.daily_scoring(spark, tables, _train_model(spark, d), store, AS_OF_O, clocks=FIXTURE_CLOCKS,
                                created_at=AS_OF_O)
    listed = report.select(F.col("customer_id").alias("listed_id"))
    rows = TB.read_predictions(spark, store).join(
        tables["customers"].select("customer_id", "account_status"), "customer_id").join(
        listed, F.col("customer_id") == F.col("listed_id"), "left")
    risky = (F.col("risk_tier") == C.HIGH_RISK) & (F.col("account_status") == C.STATUS_ACTIVE)
    p = F.col("churn_probability").cast("double")
    # a probability just under a threshold may be stored as the threshold
    close = (F.abs(p - C.HIGH_RISK_THRESHOLD) < 1e-4) | (F.abs(p - C.MEDIUM_RISK_THRESHOLD) < 1e-4)
    return rows.select("customer_id", "prediction_date", "model_version",
                       (_tier_agrees(p, F.col("risk_tier")) | close).alias("tier_agrees"),
                       (risky == F.col("listed_id").isNotNull()).alias("listed_if_risky"))
