"""Names of columns that must not meet those of the data."""

from __future__ import annotations

from collections.abc import Iterable


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, or the first of ``name_2``, ``name_3``, … that none of ``taken`` is, without regard to case."""
    lower = {t.lower() for t in taken}
    free, number = name, 2
    while free.lower() in lower:
        free, number = f"{name}_{number}", number + 1
    return free


def free_names(names: Iterable[str], taken: Iterable[str]) -> list[str]:
    """:func:`free_name` for several names that differ."""
    used = list(taken)
    found = []
    for name in names:
        found.append(free_name(name, used))
        used.append(found[-1])
    return found


def quoted(name: str) -> str:
    """A name as SQL text, and as an argument of ``F.col`` that is one name even with a dot in it."""
    return "`" + name.replace("`", "``") + "`"
