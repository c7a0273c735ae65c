"""Names of columns that can't clash with those of a caller's table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def numbered(docs: DataFrame) -> DataFrame:
    """The table with its columns named c0, c1, ... whatever they were called."""
    return docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))


def free_names(taken: Iterable[str], names: Iterable[str]) -> list[str]:
    """The names, each with as many underscores behind it as make it differ from those taken; case doesn't count."""
    used, out = {x.lower() for x in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out
