"""Queries of this subpackage: name -> callable(spark, sf_dir), and their DuckDB SQL."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco
