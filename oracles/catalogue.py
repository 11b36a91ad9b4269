"""All check queries by name."""

from __future__ import annotations

from oracles import alternative, gold, orders, silver, staging
from oracles.kinds import kinds_of
from oracles.text import Book


def book() -> Book:
    made = Book()
    staging.build(made)
    silver.build(made)
    gold.build(made)
    orders.build(made)
    alternative.build(made)
    return made


def statements() -> dict[str, str]:
    made = book()
    return {name: made.full(name, kinds_of(name, made.columns[name])) for name in made.queries if not name.startswith("_")}
