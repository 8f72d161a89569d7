"""Short ways to write Spark SQL text with nested lambda functions.

Geometry needs deep expressions over arrays. As SQL text one of them is parsed in a
single step, where building it from Column objects takes thousands of small calls
to the JVM. Texts are wrapped with ``F.expr`` where they meet a DataFrame.
"""

from __future__ import annotations

import inspect
import itertools
from collections.abc import Callable

_numbers = itertools.count()


def arrow(body: Callable[..., str]) -> str:
    """A lambda whose variables have names used nowhere else."""
    names = [f"{p}_{next(_numbers)}" for p in inspect.signature(body).parameters]
    variables = names[0] if len(names) == 1 else f"({', '.join(names)})"
    return f"{variables} -> {body(*names)}"


def each(array: str, body: Callable[..., str]) -> str:
    return f"transform({array}, {arrow(body)})"


def having(array: str, body: Callable[[str], str]) -> str:
    return f"filter({array}, {arrow(body)})"


def some(array: str, body: Callable[[str], str]) -> str:
    return f"exists({array}, {arrow(body)})"


def every(array: str, body: Callable[[str], str]) -> str:
    return f"forall({array}, {arrow(body)})"


def fold(array: str, start: str, step: Callable[[str, str], str]) -> str:
    return f"aggregate({array}, {start}, {arrow(step)})"


def neighbours(array: str, body: Callable[[str, str], str]) -> str:
    """``body`` of each two elements that follow each other."""
    steps = f"greatest(size({array}) - 1, 0)"
    return f"zip_with(slice({array}, 1, {steps}), slice({array}, 2, {steps}), {arrow(body)})"


def let(value: str, body: Callable[[str], str]) -> str:
    """Work out ``value`` once and use it many times in ``body``."""
    return f"transform(array({value}), {arrow(body)})[0]"


def row(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"


def num(value: float) -> str:
    """A double literal."""
    return f"{float(value)!r}D"
