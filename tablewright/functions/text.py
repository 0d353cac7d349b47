"""Text tests and cleaning. Functions here take a SQL expression as text and return one."""

from __future__ import annotations


def present(x: str) -> str:
    """Neither null nor blank: empty CSV cells arrive as null from one reader and '' from another."""
    return f"(coalesce(trim(cast({x} AS string)), '') <> '')"


def tidy(x: str) -> str:
    """Trimmed text, '' for null."""
    return f"coalesce(trim({x}), '')"


def tidy_upper(x: str) -> str:
    return f"upper({tidy(x)})"


def tidy_lower(x: str) -> str:
    return f"lower({tidy(x)})"


def one_of(x: str, values: list[str]) -> str:
    return f"{x} IN ({', '.join(quoted(v) for v in values)})"


def quoted(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
