"""Small helpers that write SQL text."""

from __future__ import annotations

from dataclasses import dataclass, field

def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def case(rule: str) -> str:
    """A rule on one line, whatever its layout."""
    return " ".join(rule.split())


def cases(**named: str) -> dict[str, str]:
    return {name: case(rule) for name, rule in named.items()}


def truth(condition: str) -> str:
    return f"COALESCE(({condition}), FALSE)"


def truths(conditions: dict[str, str]) -> dict[str, str]:
    return {name: truth(text) for name, text in conditions.items()}


def real(expr: str) -> str:
    return f"CAST(({expr}) AS DOUBLE)"


def rounded(expr: str, digits: int) -> str:
    """Half away from zero, decided on ten exact decimals."""
    return real(f"round(CAST(({expr}) AS DECIMAL(28,10)), {digits})")


def quotient(part: str, whole: str) -> str:
    return f"{real(part)} / NULLIF({real(whole)}, 0)"


def pct(part: str, whole: str, digits: int) -> str:
    return f"CASE WHEN {whole} > 0 THEN {rounded(f'{real(part)} * 100 / {real(whole)}', digits)} ELSE 0 END"


def share(part: str, whole: str, digits: int = 1) -> str:
    return rounded(quotient(f"({part}) * 100", whole), digits)


def truncated(part: str, whole: str) -> str:
    return f"(({part}) // NULLIF({whole}, 0)) * 100"


def n(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def total(column: str, condition: str) -> str:
    return f"COALESCE(sum({column}) FILTER (WHERE {condition}), 0)"


def mean(expr: str) -> str:
    return f"CAST(sum({expr}) AS DOUBLE) / count({expr})"


def spread(expr: str) -> str:
    """Sample standard deviation of whole numbers, from sums without rounding."""
    x = f"CAST({expr} AS HUGEINT)"
    apart = f"CAST(count({expr}) * sum({x} * {x}) - sum({x}) * sum({x}) AS DOUBLE)"
    return f"CASE WHEN count({expr}) > 1 THEN sqrt({apart} / (CAST(count({expr}) AS DOUBLE) * (count({expr}) - 1))) END"


def mean_of_means(expr: str) -> str:
    return mean(f"CAST({expr} AS DECIMAL(24,9))")


def score(*parts) -> str:
    return "least(100, greatest(0, " + " + ".join(f"({case(part)})" for part in parts) + "))"


def zero(*names: str) -> dict[str, str]:
    return {name: f"COALESCE({name}, 0)" for name in names}


def same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


def select(columns: dict[str, str], source: str, tail: str = "") -> str:
    return "SELECT " + ", ".join(f"{text} AS {name}" for name, text in columns.items()) + f" FROM {source} {tail}"


@dataclass
class Book:
    """Named queries; a query may read earlier ones by name."""

    queries: dict[str, tuple[str, tuple[str, ...]]] = field(default_factory=dict)
    columns: dict[str, list[str]] = field(default_factory=dict)

    def add(self, name: str, columns: dict[str, str], source: str, tail: str = "", reads: tuple[str, ...] = ()) -> None:
        self.add_text(name, select(columns, source, tail), list(columns), reads)

    def add_text(self, name: str, text: str, columns: list[str], reads: tuple[str, ...] = ()) -> None:
        self.queries[name] = (text, tuple(reads))
        self.columns[name] = columns

    def needed(self, name: str, found: dict[str, None] | None = None) -> dict[str, None]:
        found = {} if found is None else found
        for read in self.queries[name][1]:
            if read not in found:
                self.needed(read, found)
        found[name] = None
        return found

    def full(self, name: str, kinds: dict[str, str], leave_out: tuple[str, ...] = ()) -> str:
        """The whole statement for a query, ending in a projection to portable types."""
        steps = ", ".join(f"{step} AS ({self.queries[step][0]})" for step in self.needed(name))
        columns = {c: kinds.get(c, "{}").format(c) for c in self.columns[name] if c not in leave_out}
        return f"WITH {steps} {select(columns, name)}"
