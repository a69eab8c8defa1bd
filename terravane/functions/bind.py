"""Small pieces of SQL text shared by the expression builders.

The geometry expressions nest several lambdas. Written as SQL text they reach the JVM in one
call; the same tree built from Column objects takes thousands.
"""

from __future__ import annotations

from collections.abc import Callable


def double(value: float) -> str:
    """Double literal; a bare decimal would be read as DECIMAL."""
    return f"{value!r}D" if value >= 0 else f"({value!r}D)"


def bind(value: str, name: str, body: str | Callable[[str], str]) -> str:
    """``body`` with ``value`` evaluated once and available as ``name``.

    Catalyst shares repeated sub-expressions only in generated code; lambda bodies are
    interpreted, where a value used three times would be computed three times.
    """
    text = body if isinstance(body, str) else body(name)
    return f"get(transform(array({value}), {name} -> {text}), 0)"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
