"""Small helpers to build DuckDB/ANSI SQL text next to the Spark expressions.

The oracle SQL of every query is written from the same pattern constants as
the Spark Column code, so the two cannot drift apart.
"""

from __future__ import annotations


def lit(s: str) -> str:
    """SQL string literal (DuckDB keeps backslashes verbatim in '…')."""
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"
