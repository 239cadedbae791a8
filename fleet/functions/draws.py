"""Reproducible random draws as column expressions.

A draw is a function of a seed and of key columns, so it does not change with
the partitioning, a retried task gives the same value, and any engine that has
md5 can recompute it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

_HEX_DIGITS = 13
_SPAN = float(16**_HEX_DIGITS)


def uniform(seed: int | str, *keys: Column | str) -> Column:
    """Uniform in [0, 1) from the seed and the keys (integers or strings)."""
    return _share(_digest(seed, *keys), 1)


def drawn_below(share: float, seed: int | str, *keys: Column | str) -> Column:
    """Whether ``uniform(seed, *keys) < share``, decided on the digits of the digest."""
    if share >= 1.0:
        return F.lit(True)
    if share <= 0.0:
        return F.lit(False)
    bound = format(math.ceil(share * _SPAN), f"0{_HEX_DIGITS}x")
    return F.substring(_digest(seed, *keys), 1, _HEX_DIGITS) < F.lit(bound)


def uniform_pair(seed: int | str, *keys: Column | str) -> tuple[Column, Column]:
    """Two independent draws from one digest."""
    digest = _digest(seed, *keys)
    return _share(digest, 1), _share(digest, 1 + _HEX_DIGITS)


def uniform_between(low: Column | float, high: Column | float, draw: Column) -> Column:
    low, high = _column(low), _column(high)
    return low + draw * (high - low)


def loguniform_between(low: float, high: float, draw: Column) -> Column:
    return F.exp(F.lit(math.log(low)) + draw * F.lit(math.log(high) - math.log(low)))


def integer_between(low: int, high: int, draw: Column) -> Column:
    """Integer in [low, high); the upper end is not drawn."""
    return (F.lit(low) + F.floor(draw * F.lit(high - low))).cast("long")


def _digest(seed: int | str, *keys: Column | str) -> Column:
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns]))


def _share(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, _HEX_DIGITS), 16, 10).cast("double") / F.lit(_SPAN)


def normal(first: Column, second: Column) -> Column:
    """Standard normal from two uniform draws."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - first))
    return radius * F.cos(F.lit(2.0 * math.pi) * second)


def label_below(classes: int, draw: Column) -> Column:
    return F.floor(draw * F.lit(classes)).cast("int")


def _column(value: Column | float) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))
