"""Thresholds, windows and model parameters.

Fixed values that must equal the reference's for identical results are kept
together here, in natural order, as plain constants.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------

# Risk tiers on churn probability: >= 0.70 high, >= 0.40 medium, else low.
HIGH_RISK_THRESHOLD = 0.70
MEDIUM_RISK_THRESHOLD = 0.40
HIGH_RISK = "High Risk"
MEDIUM_RISK = "Medium Risk"
LOW_RISK = "Low Risk"

# Lifecycle stage on tenure in days: < 90 New, < 365 Growing, else Established.
NEW_MAX_DAYS = 90
GROWING_MAX_DAYS = 365
STAGE_NEW = "New"
STAGE_GROWING = "Growing"
STAGE_ESTABLISHED = "Established"

# Status and category literals used by the feature queries.
STATUS_CHURNED = "Churned"
STATUS_ACTIVE = "Active"
EVENT_FEATURE_ADOPTION = "feature_adoption"
PAYMENT_LATE = "Late"
PAYMENT_FAILED = "Failed"
PAYMENT_PAID = "Paid"
PRIORITY_HIGH = "High"
PRIORITY_CRITICAL = "Critical"
TICKET_ESCALATED = "Escalated"
TICKET_REOPENED = "Reopened"
TICKET_RESOLVED = "Resolved"

# Look-back windows.
CUSTOMER_BASE_YEARS = 2
USAGE_MONTHS = 6
USAGE_RECENT_MONTHS = 1
USAGE_PREVIOUS_MONTHS = 3
USAGE_TREND_PREFILTER_MONTHS = 4
FINANCIAL_MONTHS = 12
REVENUE_RECENT_MONTHS = 3
REVENUE_PREVIOUS_MONTHS = 6
REVENUE_TREND_PREFILTER_MONTHS = 9
SUPPORT_MONTHS = 6
MARKETING_MONTHS = 6

# Columns never used as model features.
EXCLUDED_FEATURE_COLUMNS = (
    "customer_id",
    "churned",
    "signup_date",
    "account_status",
    "last_login_date",
    "last_invoice_date",
    "last_ticket_date",
)

# Recommended action per tier (README business recommendations).
TIER_ACTIONS = (
    (HIGH_RISK, "Immediate Action", "Assign CSM for personal outreach"),
    (MEDIUM_RISK, "Nurture Campaign", "Automated email re-engagement"),
    (LOW_RISK, "Health Monitoring", "Quarterly business reviews"),
)

DEFAULT_MODEL_VERSION = "v1.0"


@dataclass(frozen=True)
class ForestParams:
    """Random-forest parameters; defaults are the reference's."""

    num_trees: int = 200
    max_depth: int = 15
    min_instances_per_node: int = 10  # min leaf 10 implies min split 20
    feature_subset_strategy: str = "sqrt"
    seed: int = 42
    class_weight_balanced: bool = True


@dataclass(frozen=True)
class SplitParams:
    test_fraction: float = 0.2
    seed: int = 42


@dataclass(frozen=True)
class LiftThresholds:
    """Indicator thresholds for the churn-lift report (README values)."""

    inactive_days: float = 14
    tickets_per_month: float = 3
    feature_share: float = 0.30
    late_payments: int = 1
    ticket_window_months: int = SUPPORT_MONTHS
