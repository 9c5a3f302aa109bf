"""Small helpers that render constant expressions as Spark SQL text.

A long ``CASE`` or ``IN`` list built through ``F.when`` / ``Column.isin`` costs
one Py4J round trip per branch or value on the driver; the same expression as
SQL text is a single call, parsed in the JVM. The resulting plan is identical.
"""

from __future__ import annotations

from typing import Iterable


def quote(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def in_list(col_sql: str, values: Iterable[str]) -> str:
    vals = list(dict.fromkeys(values))
    if not vals:
        return "false"
    return f"{col_sql} IN ({', '.join(quote(v) for v in vals)})"


def case_lookup(key_sql: str, table: dict[int, str], default_prefix: str) -> str:
    """``CASE key WHEN k THEN 'v' ... ELSE prefix || key END``."""
    whens = " ".join(f"WHEN {k} THEN {quote(v)}" for k, v in table.items())
    return f"CASE {key_sql} {whens} ELSE concat({quote(default_prefix)}, CAST({key_sql} AS STRING)) END"
