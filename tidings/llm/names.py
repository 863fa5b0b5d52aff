"""Names for working columns beside an input's own."""

from __future__ import annotations


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores in front as no column of
    ``columns`` (in any case) and no other of the names has."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
