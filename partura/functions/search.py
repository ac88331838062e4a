"""Binary search in sorted arrays, as SQL text."""

from __future__ import annotations

from collections.abc import Callable


def count_while(array: str, holds: Callable[[str], str]) -> str:
    """How many elements at the front of a sorted array meet a condition which, once it fails, fails
    for all that follow. Looks at as many elements as the array's size has binary digits."""
    probe = "at + shiftleft(1, k)"
    found = f"{probe} <= size({array}) AND {holds(f'get({array}, {probe} - 1)')}"
    steps = f"sequence(length(bin(size({array}))) - 1, 0, -1)"
    return (
        f"IF(coalesce(size({array}), 0) < 1, 0, "
        f"aggregate({steps}, 0, (at, k) -> IF({found}, {probe}, at)))"
    )


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for a value that is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"
