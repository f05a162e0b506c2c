"""Expressions of the drift statistics and of the status rules."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bins per histogram, floor for empty bins, status thresholds.
BINS = 10
EMPTY_BIN = 1e-10
PSI_CRITICAL = 0.25
PSI_WARNING = 0.1
KS_P_WARNING = 0.05
KS_D_WARNING = 0.1


def finite_double(raw: Column) -> Column:
    """Numeric reading of a value; text that is no number, NaN and infinities give null."""
    number = raw.try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def equal_width_bin(value: Column, low: Column, high: Column, bins: int = BINS) -> Column:
    """Zero-based bin: how many of the inner edges are at or below the value.

    The last bin holds the maximum too. Comparing with explicit edges keeps both engines and
    NumPy on the same bin for values that sit on an edge.
    """
    # The difference of two finite doubles may be none.
    parts = F.lit(float(bins))
    step = F.when(high / 2 - low / 2 < 2.0**1022, (high - low) / parts).otherwise(high / parts - low / parts)
    hits = [(value >= low + F.lit(float(i)) * step).cast("int") for i in range(1, bins)]
    total = hits[0]
    for hit in hits[1:]:
        total = total + hit
    return total


def ks_pvalue(d: Column, n: Column, m: Column) -> Column:
    """Two-sided asymptotic p-value of the two-sample KS statistic.

    Kolmogorov's series 2 * sum (-1)^(k-1) exp(-2 k^2 t^2), t = D * sqrt(nm / (n + m)), cut at
    100 terms; below t = 1, where it converges slowly, the complement of
    sqrt(2 pi) / t * sum exp(-(2k-1)^2 pi^2 / (8 t^2)). For small samples an exact method can give a
    different number.
    """
    n, m = n.cast("double"), m.cast("double")
    t = d * F.sqrt(n * m / (n + m))
    near = F.aggregate(
        F.sequence(F.lit(1), F.lit(20)),
        F.lit(0.0),
        lambda acc, k: acc + F.exp(F.lit(-math.pi**2 / 8) * (2 * k - 1) * (2 * k - 1) / (t * t)),
    )
    small = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / t * near
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(F.lit(-2.0) * k * k * t * t),
    )
    value = F.when(t < 1, small).otherwise(F.lit(2.0) * series)
    return F.when(t * t == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def share(count: Column, total: Column) -> Column:
    """Share of a bin, with the floor for an empty one."""
    return F.when(count == 0, F.lit(EMPTY_BIN)).otherwise(count.cast("double") / total.cast("double"))


def psi_term(current: Column, historical: Column) -> Column:
    return (current - historical) * F.ln(current / historical)


def drift_status(psi: Column, p_value: Column, d: Column) -> Column:
    return (
        F.when(psi > PSI_CRITICAL, "CRITICAL")
        .when(psi > PSI_WARNING, "WARNING")
        .when((p_value < KS_P_WARNING) & (d > KS_D_WARNING), "WARNING")
        .otherwise("PASS")
    )
