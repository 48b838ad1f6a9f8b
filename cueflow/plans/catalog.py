"""The query catalogue: every module of registered queries, gathered."""

from __future__ import annotations

from cueflow.plans import chapters, discovery, joins, planning, reporting, reports, scans, sequence, text, timing  # noqa: F401  (they register their queries)
from cueflow.plans.registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
