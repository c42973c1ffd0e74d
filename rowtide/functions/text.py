"""SQL text for expressions that are built for very many columns."""

from __future__ import annotations


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ratio(a: str, b: str) -> str:
    """Division that yields NULL for a zero denominator."""
    return f"try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"


def filled(value: str, fill: float = -1.0) -> str:
    """A floating value with missing and infinite replaced; NaN sorts above infinity."""
    return f"CASE WHEN abs({value}) < double('Infinity') THEN {value} ELSE double({fill}) END"
