"""Three-part model versions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_three_part(version: Column) -> Column:
    return F.coalesce(F.size(F.split(version, r"\.", -1)) == 3, F.lit(False))


def sort_key(version: Column) -> Column:
    """Numeric parts, so that 0.1.10 comes after 0.1.9; a part that is no number counts as 0."""
    return F.transform(
        F.split(version, r"\.", -1), lambda part: F.coalesce(part.try_cast("int"), F.lit(0))
    )


def next_patch(version: Column) -> Column:
    """Version with the patch raised by one; null unless there are exactly three parts."""
    parts = sort_key(version)
    return F.when(
        is_three_part(version),
        F.concat_ws(
            ".",
            parts[0].cast("string"),
            parts[1].cast("string"),
            (parts[2] + 1).cast("string"),
        ),
    )
