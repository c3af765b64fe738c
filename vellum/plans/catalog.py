"""All queries of the engine by name, and the SQL that checks them."""

from __future__ import annotations

from . import q_costs, q_jobs, q_layout, q_render, q_reports, q_structure, q_tables
from .views import oracle

MODULES = [q_tables, q_costs, q_structure, q_layout, q_jobs, q_render, q_reports]


def queries() -> dict:
    return {name: f for m in MODULES for name, (f, _) in m.RUNS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: oracle(sql) for m in MODULES for name, (_, sql) in m.RUNS.items() if sql}
