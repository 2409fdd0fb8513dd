"""Column names."""

from __future__ import annotations


def free_name(columns: list[str], wanted: str) -> str:
    """The wanted name, with underscores added while a column has it, whatever its case."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
