"""The one shape every rule table takes: ordered (condition, value) pairs and a default."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    pairs: tuple[tuple[str, object], ...]
    default: object


def rules(default, *pairs: tuple[str, object]) -> Rules:
    return Rules(tuple(pairs), default)


def band(column: str, cuts: Iterable[tuple[float, object]], default, op: str = ">=") -> Rules:
    """Threshold ladder on one column."""
    return Rules(tuple((f"{column} {op} {cut}", value) for cut, value in cuts), default)


def lookup(column: str, values: Mapping[str, object], default) -> Rules:
    """Exact match on one column."""
    return Rules(tuple((f"{column} = '{key}'", value) for key, value in values.items()), default)


def any_of(column: str, *labels: str) -> str:
    return f"{column} IN ({', '.join(repr(label) for label in labels)})"
