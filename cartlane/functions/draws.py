"""Seeded draws.

A draw is a number made from the MD5 digest of the row's key and a seed, so a rerun, a
retried task or another engine gets the same value for the same row. ``F.rand`` gives no
such promise, because its values depend on how rows are spread over partitions.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# 15 hex digits: 60 bits, always a non-negative bigint.
_HEX_DIGITS = 15


def _col(key) -> Column:
    return F.col(key) if isinstance(key, str) else key


def draw(seed: str, *keys) -> Column:
    """A bigint in [0, 2**60), fixed by the keys and the seed."""
    text = F.concat_ws(":", *[_col(k).cast("string") for k in keys], F.lit(seed))
    return F.conv(F.substring(F.md5(text), 1, _HEX_DIGITS), 16, 10).cast("bigint")


def draw_int(seed: str, low: int, high: int, *keys) -> Column:
    """A whole number in [low, high]."""
    return F.pmod(draw(seed, *keys), F.lit(high - low + 1)) + F.lit(low)


def draw_decimal(seed: str, low: str, high: str, scale: int, *keys) -> Column:
    """A decimal in [low, high] on a grid of ``scale`` places."""
    step = 10**scale
    first = int(Decimal(low) * step)
    steps = draw_int(seed, first, int(Decimal(high) * step), *keys)
    return (steps.cast("decimal(18,0)") * F.lit(Decimal(1) / step)).cast(f"decimal(18,{scale})")


def draw_choice(seed: str, values: list, *keys) -> Column:
    """One of a list of literals."""
    choices = F.array(*[F.lit(v) for v in values])
    return F.element_at(choices, draw_int(seed, 1, len(values), *keys).cast("int"))


def draw_chance(seed: str, hits: int, of: int, *keys) -> Column:
    """True for ``hits`` out of ``of`` equally likely draws."""
    return F.pmod(draw(seed, *keys), F.lit(of)) >= F.lit(of - hits)


# The prime modulus and two multipliers of well-tested congruential generators.
_PRIME = 2**31 - 1
_MULTIPLIERS = (48271, 69621)


def draw_series(seed: str, count: int, *keys) -> list[Column]:
    """``count`` draws in [0, 2**62) for each row, from one digest.

    The halves of one draw start two congruential sequences; the i-th member of each is the
    start times a constant. That is much cheaper than a digest for each.
    """
    start = draw(seed, *keys)
    high = F.shiftright(start, 30) + 1
    low = F.pmod(start, F.lit(2**30)) + 1

    def member(half: Column, multiplier: int, i: int) -> Column:
        return F.pmod(half * F.lit(pow(multiplier, i, _PRIME)), F.lit(_PRIME))

    first, second = _MULTIPLIERS
    return [
        member(high, first, i) * F.lit(2**31) + member(low, second, i) for i in range(1, count + 1)
    ]
