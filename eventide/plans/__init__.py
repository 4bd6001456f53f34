"""Registered queries: one Spark plan per operator of the inventory, each with
the DuckDB SQL that defines its expected result (where SQL can express it)."""

from eventide.plans.registry import ORACLES, QUERIES

# Importing the modules fills the registry.
from eventide.plans import stateless, windowed, joined, sequenced, sinks, userdefined  # noqa: E402,F401

__all__ = ["QUERIES", "ORACLES"]
