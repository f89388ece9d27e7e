"""Query key -> (Spark callable, DuckDB oracle SQL or None).

Every key has an SQL twin.
"""

from __future__ import annotations

from . import analytics, forest, primitives, rolling  # noqa: F401  (forest and rolling register with analytics)
from .queries import ORACLE as COMPOSITE_ORACLE
from .queries import QUERIES as COMPOSITE
from .queries import QueryFn

QUERIES: dict[str, QueryFn] = {**COMPOSITE, **primitives.QUERIES, **analytics.QUERIES}
ORACLE: dict[str, str] = {**COMPOSITE_ORACLE, **primitives.ORACLE, **analytics.ORACLE}


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
