"""Registered queries: inputs derived from the given tables, the operator under test, and oracle SQL."""

from __future__ import annotations


def all_queries():
    """(queries, oracle SQL) of all modules."""
    from workload import q_features, q_lookups, q_observations, q_plans, q_profiles, q_shape, q_streams  # noqa: F401
    from workload.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
