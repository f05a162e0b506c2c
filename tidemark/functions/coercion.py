"""Turning request texts into typed inputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of the declared input types.
WHOLE = ("int", "integer")
REAL = ("float", "double")
# What counts as a whole number and as a decimal number in a request text.
WHOLE_SHAPE = r"^[+-]?\d+$"
NUMBER_SHAPE = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def whole_number(text: Column) -> Column:
    return F.when(text.rlike(WHOLE_SHAPE), text.try_cast("bigint"))


def real_number(text: Column) -> Column:
    return F.when(text.rlike(NUMBER_SHAPE), text.try_cast("double"))


def declared_input(text: Column, declared: Column) -> Column:
    """Struct of the value read by its declared type.

    Whole numbers fall back to 0 and reals to 0.0; every other declared type stays text.
    """
    cleaned, kind = F.trim(text), F.lower(declared)
    return F.struct(
        F.when(kind.isin(*WHOLE), F.coalesce(whole_number(cleaned), F.lit(0).cast("bigint"))).alias(
            "whole_value"
        ),
        F.when(kind.isin(*REAL), F.coalesce(real_number(cleaned), F.lit(0.0))).alias("real_value"),
        F.when(~kind.isin(*WHOLE, *REAL), cleaned).alias("text_value"),
    )


def guessed_kind(text: Column) -> Column:
    """Type of an undeclared value: with a dot real, else whole, else real, else text."""
    number = real_number(text)
    return (
        F.when(text.contains(".") & number.isNotNull(), "real")
        .when(~text.contains(".") & whole_number(text).isNotNull(), "whole")
        .when(number.isNotNull(), "real")
        .otherwise("text")
    )


def guessed_number(text: Column) -> Column:
    """The number behind a real or whole text, null for plain text."""
    return real_number(text)
