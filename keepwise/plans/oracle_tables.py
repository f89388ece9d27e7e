"""DuckDB definitions of the business tables over the driver's raw tables.

Each oracle query is ``WITH <adapters> <query>``: the adapters restate
``FIXTURES.md`` in DuckDB SQL.
"""

from __future__ import annotations

AS_OF_ORDERS_SQL = "TIMESTAMP '2001-02-01 00:00:00'"
AS_OF_EVENTS_SQL = "TIMESTAMP '2024-02-15 00:00:00'"

_H = "('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ':p'), 1, 8))::BIGINT"

ADAPTERS: dict[str, str] = {
    "customers": f"""customers AS (
    SELECT c.c_custkey AS customer_id,
           TIMESTAMP '1998-02-01 00:00:00' + to_days(CAST((c.c_custkey * 37) % 1096 AS INTEGER)) AS signup_date,
           CASE WHEN a.o_custkey IS NOT NULL THEN 'Active' ELSE 'Churned' END AS account_status,
           n.n_name AS country,
           CASE WHEN c.c_acctbal < 2500 THEN 'Small' WHEN c.c_acctbal < 6500 THEN 'Medium' ELSE 'Large' END AS company_size,
           c.c_mktsegment AS industry,
           CASE c.c_custkey % 3 WHEN 0 THEN 'Basic' WHEN 1 THEN 'Pro' ELSE 'Enterprise' END AS plan_type,
           CASE WHEN c.c_custkey % 50 = 0 THEN 1 ELSE 0 END AS is_test_account,
           c.c_name AS company_name,
           'AM-' || CAST(c.c_nationkey AS VARCHAR) AS account_manager
    FROM customer c
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN (SELECT DISTINCT o_custkey FROM orders
               WHERE o_orderdate >= {AS_OF_ORDERS_SQL}
                 AND o_orderdate < {AS_OF_ORDERS_SQL} + INTERVAL 6 MONTH) a
           ON a.o_custkey = c.c_custkey
)""",
    "user_activity": """user_activity AS (
    SELECT user_id AS customer_id,
           CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d%H') AS session_id,
           ts AS login_date,
           CAST(value AS DECIMAL(10,2)) AS session_duration_minutes,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS feature_id,
           CASE WHEN event_type = 'signup' THEN 'feature_adoption' ELSE event_type END AS event_type,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS api_calls
    FROM events
)""",
    "invoices": """invoices AS (
    SELECT o_custkey AS customer_id,
           CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
           o_orderdate AS invoice_date,
           CASE o_orderstatus WHEN 'F' THEN 'Paid' WHEN 'O' THEN 'Late' WHEN 'P' THEN 'Failed' END AS payment_status
    FROM orders
)""",
    "support_tickets": """support_tickets AS (
    SELECT o.o_custkey AS customer_id,
           l.l_shipdate + to_minutes(CAST(l.l_linenumber * 17 AS BIGINT)) AS created_date,
           CASE WHEN l.l_returnflag = 'N' THEN NULL
                ELSE l.l_shipdate + to_minutes(CAST(l.l_linenumber * 17 AS BIGINT))
                     + to_minutes(CAST(l.l_quantity * 37 AS BIGINT)) END AS resolved_date,
           CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Critical' WHEN '2-HIGH' THEN 'High'
                WHEN '3-MEDIUM' THEN 'Medium' ELSE 'Low' END AS priority,
           CASE WHEN l.l_returnflag = 'A' THEN 'Resolved'
                WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN 'Escalated'
                WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'Reopened'
                ELSE 'Open' END AS status,
           CASE WHEN l.l_returnflag = 'N' THEN NULL ELSE CAST(1 + l.l_linenumber % 5 AS INTEGER) END AS satisfaction_score
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)""",
    "marketing_engagement": """marketing_engagement AS (
    SELECT user_id AS customer_id,
           ts AS sent_date,
           CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END AS opened,
           CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS clicked,
           CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS unsubscribed,
           CAST(json_extract_string(props, '$.k') AS INTEGER) % 11 AS nps_score,
           CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 AS campaign_id
    FROM events
)""",
    "churn_predictions": f"""churn_predictions AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS prediction_id,
           o_custkey AS customer_id,
           CAST(o_orderdate AS DATE) AS prediction_date,
           CAST(CAST({_H} % 10001 AS DOUBLE) / 10000.0 AS DECIMAL(5,4)) AS churn_probability,
           CASE WHEN CAST({_H} % 10001 AS DOUBLE) / 10000.0 >= 0.7 THEN 'High Risk'
                WHEN CAST({_H} % 10001 AS DOUBLE) / 10000.0 >= 0.4 THEN 'Medium Risk'
                ELSE 'Low Risk' END AS risk_tier,
           'v1.0' AS model_version,
           o_orderdate + to_minutes(CAST((o_orderkey * 7) % 1440 AS BIGINT)) AS created_at
    FROM orders
)""",
}

ORDER = ["customers", "user_activity", "invoices", "support_tickets", "marketing_engagement",
         "churn_predictions"]


def with_tables(*names: str, extra: list[str] | None = None) -> str:
    """``WITH`` clause holding the named adapters (in dependency order) and
    any extra CTE texts appended after them."""
    parts = [ADAPTERS[n] for n in ORDER if n in names]
    parts += list(extra or [])
    return "WITH " + ",\n".join(parts) + "\n"
