"""All registered queries (import side effects fill the registry)."""

from __future__ import annotations

from tabprep.plans import q_balance, q_eval, q_fit, q_model, q_prep, q_profile, q_report, q_select  # noqa: F401
from tabprep.plans.registry import IDS, ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE", "IDS"]
