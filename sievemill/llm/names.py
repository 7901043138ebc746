"""Names of inner columns that no column of a table has."""

from __future__ import annotations

from collections.abc import Iterable


def unused(columns: Iterable[str], name: str) -> str:
    """The name, lengthened until no column starts with it in any letter case."""
    taken = [c.lower() for c in columns]
    while any(c.startswith(name.lower()) for c in taken):
        name += "_"
    return name
