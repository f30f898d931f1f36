"""Query register: name -> (Spark builder, oracle SQL)."""

from __future__ import annotations

from orrery.plans import q_exact, q_files, q_models, q_ratings, q_text  # noqa: F401  (registers queries)
from orrery.plans.common import REGISTRY


def queries():
    return {name: q.build for name, q in REGISTRY.items()}


def oracle_sql():
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
