"""Column names that clash with none of a table's."""

from __future__ import annotations


def fresh(columns: list[str], *stems: str) -> list[str]:
    """The stems, each made longer than any of the columns."""
    longest = max((len(c) for c in columns), default=0)
    return [stem + "_" * (longest + 1) for stem in stems]
