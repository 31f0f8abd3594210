"""Queries over the given tables, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from importlib import import_module


def load():
    """The registry, filled."""
    for part in ("q_rules", "q_star", "q_marts", "q_stream", "q_profile", "q_checks", "q_lake", "q_open"):
        import_module(f"monthlake.catalogue.{part}")
    return import_module("monthlake.catalogue.registry")
