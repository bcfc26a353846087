"""Imports every registry module so that QUERIES / ORACLES are complete."""

from dimloom.plans import q_audit, q_clean, q_dims, q_fact, q_load  # noqa: F401
from dimloom.plans.registry import ORACLES, QUERIES

FLAGSHIP = "fact_view"

__all__ = ["QUERIES", "ORACLES", "FLAGSHIP"]
