"""Text clean-up built from JVM-side functions only."""

from __future__ import annotations

_RUNS = r"[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+"


def title_case(name: str) -> str:
    """Capitalise each run of letters and digits, so ``mary-ann`` gives ``Mary-Ann``
    (``initcap`` would only break at blanks)."""
    runs = f"regexp_extract_all({name}, '{_RUNS}', 0)"
    return f"array_join(transform({runs}, r -> upper(left(r, 1)) || lower(substring(r, 2))), '')"


def joined(*pieces: str) -> str:
    """Concatenation that skips missing pieces."""
    return f"concat_ws('', {', '.join(pieces)})"
