"""Reproducible uniform draws keyed by customer.

``rand`` gives other numbers after every repartitioning or task retry. These draws depend on the id alone, so
labels, splits and folds come out the same in any engine and under any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Multiplier and increment of each independent draw.
STREAMS = {
    "stale": (1103515245, 12345),
    "segment": (1664525, 1013904223),
    "senior": (22695477, 1),
    "split": (134775813, 2531011),
}
MODULUS = 2147483648
PRIME = 2147483647
HIGH_WORD_MULTIPLIER = 69069


def uniform_draw(key: str | Column, stream: str) -> Column:
    """A draw in [0, 1) from ``key``.

    The key is reduced before it is multiplied, so that no bigint id overflows; ids beyond 2**31 mix their
    upper part in. Squaring breaks the serial correlation that the linear step alone leaves between neighbours.
    """
    multiplier, increment = STREAMS[stream]
    key = (F.col(key) if isinstance(key, str) else key).cast("bigint")
    low = F.pmod(key, F.lit(MODULUS))
    high = F.shiftright(key, 31)
    mixed = F.pmod(low * F.lit(multiplier) + high * F.lit(HIGH_WORD_MULTIPLIER) + F.lit(increment), F.lit(MODULUS))
    return F.pmod(mixed * mixed, F.lit(PRIME)).cast("double") / F.lit(float(PRIME))
