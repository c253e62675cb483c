"""Column names: lower case, with blanks and hyphens as underscores."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

_SEPARATORS = str.maketrans({" ": "_", "-": "_"})


def silver_name(raw: str) -> str:
    return raw.lower().translate(_SEPARATORS)


def silver_names(raw: Iterable[str]) -> list[str]:
    """Silver names in the same order; ValueError if two raw names become one."""
    names = [silver_name(n) for n in raw]
    clashes = sorted(n for n, seen in Counter(names).items() if seen > 1)
    if clashes:
        raise ValueError(f"Raw columns collide after normalisation: {', '.join(clashes)}")
    return names
