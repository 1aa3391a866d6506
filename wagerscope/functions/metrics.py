"""Money, ratio and share expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")


def ratio(num: Column | str, den: Column | str, default: float | None = None) -> Column:
    """``num / den`` in doubles; ``default`` (NULL if not given) when ``den`` is 0 or NULL."""
    out = F.try_divide(as_double(num), as_double(den))
    return out if default is None else F.coalesce(out, F.lit(float(default)))


def mean(col: Column | str) -> Column:
    """Mean from an exact sum, so the result does not depend on the order of rows."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_divide(F.sum(c).cast("double"), F.count(c))


def money_sum(col: Column | str) -> Column:
    """Exact decimal sum handed over as a double."""
    return F.sum(F.col(col) if isinstance(col, str) else col).cast("double")


def pct(num: Column, den: Column, digits: int | None = 1) -> Column:
    """Share in percent, rounded half up on decimals; NULL when ``den`` is 0."""
    share = F.try_divide(as_double(num) * 100.0, as_double(den))
    return share if digits is None else F.round(share, digits)


def ggr(net: Column | str, mode: str = "house") -> Column:
    """Gross gaming revenue as an aggregate over ``net`` (the player's win minus bet).

    The definitions in use differ, so each operator names the one it keeps:

    * ``house``: what the house kept, negative when players won overall
    * ``losses``: the lost amounts only, winnings are not set against them
    * ``absolute``: the size of the overall result, whoever won
    * ``player``: the overall result seen from the player
    * ``house_or_zero``: as ``house``, but 0 when players won overall
    """
    n = F.col(net) if isinstance(net, str) else net
    if mode == "house":
        return F.sum(-n)
    if mode == "losses":
        return F.sum(F.when(n < 0, -n).otherwise(F.lit(0)))
    if mode == "absolute":
        return F.abs(F.sum(n))
    if mode == "player":
        return F.sum(n)
    if mode == "house_or_zero":
        return F.greatest(F.sum(-n), F.lit(0))
    raise ValueError(f"unknown ggr mode: {mode}")


def sample_skewness(col: Column | str) -> Column:
    """Skewness with the small-sample factor; NULL below three rows."""
    c = as_double(col)
    n = F.count(c).cast("double")
    return F.when(F.count(c) > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))
