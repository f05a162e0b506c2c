"""Stable assignment of entities to traffic buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_prefix(text: Column, digits: int) -> Column:
    """Leading hex digits of the md5 as a number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("bigint")


def traffic_bucket(entity: Column) -> Column:
    """Bucket 0 to 99; the same entity always lands in the same one."""
    return md5_prefix(entity, 8) % 100


def canary_arm(entity: Column, percent: int) -> Column:
    return F.when(traffic_bucket(entity) < percent, "canary").otherwise("stable")
