"""Numeric helpers (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c


def safe_div(a, n) -> Column:
    """a / n with a zero or NULL denominator giving NULL (ANSI-safe)."""
    return F.try_divide(_c(a).cast("double"), F.nullif(_c(n), F.lit(0)).cast("double"))


def round_half_even(c, digits: int = 1) -> Column:
    """Banker's rounding."""
    return F.bround(_c(c), digits)


def marker_size(c) -> Column:
    """sqrt(x) ** 2.5, the dampened bubble size of the district map."""
    return F.pow(F.sqrt(_c(c)), F.lit(2.5))


def quota(hits, total, slots: int) -> Column:
    """Slots in proportion hits/total, half-even rounded, at least 1.

    With no hits anywhere (total 0) the share is undefined; we fall back to
    the floor of 1 slot.
    """
    share = F.bround(F.try_divide(F.lit(slots) * _c(hits).cast("double"),
                                  F.nullif(_c(total), F.lit(0)).cast("double")), 0)
    return F.greatest(F.lit(1), F.coalesce(share, F.lit(1.0)).cast("int"))
