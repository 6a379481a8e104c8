"""The same scalar policy as :mod:`tideframe.functions.numeric`, as Spark SQL text.

Wide feature sets are projected with ``selectExpr``: a hundred columns written as text cost one
call into the JVM per projection instead of several per operator.
"""

from __future__ import annotations

import math


def number(x: float) -> str:
    """A double literal, infinities included."""
    return f"double('{'-' if x < 0 else ''}Infinity')" if math.isinf(x) else f"{float(x)!r}D"


def quoted(name: str) -> str:
    """A column of exactly this name, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ieee_div(a: str, b: str) -> str:
    """``a / b`` where x/0 is signed infinity and 0/0 is NULL."""
    by_zero = f"CASE WHEN ({a}) > 0 THEN double('Infinity') WHEN ({a}) < 0 THEN double('-Infinity') END"
    return f"CASE WHEN ({b}) = 0 THEN {by_zero} ELSE nullif(try_divide({a}, {b}), double('NaN')) END"


def finite(c: str) -> str:
    """NULL for infinity and NaN."""
    return f"CASE WHEN abs({c}) < double('Infinity') THEN {c} END"


def hours_between(later: str, earlier: str) -> str:
    return f"(unix_micros({later}) - unix_micros({earlier})) / 3.6e9D"


def cyclic(value: str, period: int) -> tuple[str, str]:
    angle = f"{2 * math.pi!r}D * {value} / {float(period)!r}D"
    return f"sin({angle})", f"cos({angle})"


def project(columns: dict[str, str]) -> list[str]:
    return [f"{expr} AS `{name}`" for name, expr in columns.items()]
