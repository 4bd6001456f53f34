"""Operators of a training-data pipeline over web-scale text tables.

Each module holds one operator with its own general interface; the registered
queries (``opN_<name>``) and their DuckDB SQL are in :mod:`eventide.llm.queries`.
Nothing outside this package imports it.
"""
