"""Names for columns that an operator adds on its way, apart from those a table has already."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each made longer until the frame has no column of that name, in any case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
