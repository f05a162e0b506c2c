"""How finely a time axis must be cut so that no task gets too much of one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The units to choose from, coarse to fine.
UNITS = ("day", "hour", "minute", "second")
# A key may have this many rows in one bucket.
BUCKET_ROWS = 2_000_000


def fitting_unit(
    points: DataFrame, keys: list[str], axis: str, limit: int = BUCKET_ROWS
) -> str:
    """Coarsest unit at which no key has more than ``limit`` rows in a bucket.

    Each try is one count per key and bucket, combined map-side, of which a single number
    reaches the driver. The finest unit is the last resort.
    """
    for unit in UNITS[:-1]:
        sizes = points.groupBy(*keys, F.date_trunc(unit, axis)).agg(F.count(F.lit(1)).alias("rows"))
        if (sizes.agg(F.max("rows")).first()[0] or 0) <= limit:
            return unit
    return UNITS[-1]
