"""Building blocks for SQL expression text.

Wide expressions with many literals or nested lambdas are written as SQL text: it reads closer to
the rule and reaches the JVM in one call instead of one call per node.
"""

from __future__ import annotations

from collections.abc import Iterable


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def listed(values: Iterable) -> str:
    return ", ".join(literal(value) for value in values)


def one_of(column: str, values: Iterable) -> str:
    """``column IN (...)``; no values means never."""
    values = tuple(values)
    return f"{column} IN ({listed(values)})" if values else "false"


def lookup(values: dict[str, int], key: str) -> str:
    pairs = (item for pair in values.items() for item in pair)
    return f"try_element_at(map({listed(pairs)}), {key})"


def struct(**fields: str) -> str:
    return f"named_struct({', '.join(f'{literal(k)}, {v}' for k, v in fields.items())})"
