"""Registered queries (one per operator of the survey) and their DuckDB oracles."""

from __future__ import annotations


def _modules():
    from curatio.queries import curation, jobs, sensors

    return curation, jobs, sensors


def all_queries() -> dict:
    return {k: v for m in _modules() for k, v in m.QUERIES.items()}


def all_oracles() -> dict:
    return {k: v for m in _modules() for k, v in m.ORACLE.items()}
