"""Small helpers for expressions written as Spark SQL text.

Expressions of this package are SQL text, composed with f-strings and handed to
``selectExpr``, ``where`` or ``expr``: one call to the JVM per expression, where a rule
table built out of Column objects takes hundreds.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def text(value: str) -> str:
    """String literal. Only for the fixed values of this package, never for input."""
    if "'" in value or "\\" in value:
        raise ValueError(f"not a plain text: {value!r}")
    return f"'{value}'"


def text_list(values: Iterable[str]) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


def any_of(conditions: Iterable[str]) -> str:
    return "(" + " OR ".join(conditions) + ")"


def first_match(rules: Iterable[tuple[str, str]], otherwise: str = "NULL") -> str:
    """CASE over (condition, value) pairs."""
    whens = " ".join(f"WHEN {condition} THEN {value}" for condition, value in rules)
    return f"CASE {whens} ELSE {otherwise} END"


def text_map(pairs: Iterable[tuple[str, str]]) -> str:
    return "map(" + ", ".join(text(t) for pair in pairs for t in pair) + ")"


def aliased(expressions: Mapping[str, str]) -> list[str]:
    """``{name: expression}`` for ``selectExpr``."""
    return [f"{expression} AS {name}" for name, expression in expressions.items()]


def aggregates(expressions: Mapping[str, str]) -> list[Column]:
    """``{name: aggregate}`` for ``agg``."""
    return [F.expr(e) for e in aliased(expressions)]
