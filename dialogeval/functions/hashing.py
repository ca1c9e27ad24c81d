"""Seeded hash keys.

Shuffles, splits and samples all order rows by `md5(seed:id)`. The key needs no global state, does not
depend on partitioning or on a task being run twice, and any engine with md5 can recompute it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 1 << 32


def hash_key(seed: int | str, *columns: Column) -> Column:
    """32 hex digits that order rows at random for one seed."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *columns))


def hash_number(text: Column) -> Column:
    """First 32 bits of `md5(text)` as a non-negative bigint."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def below_fraction(key: Column, fraction: float) -> Column:
    """True for the share `fraction` of hash keys; a row-local test, so it needs no shuffle."""
    first_bits = F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")
    return first_bits < F.lit(int(fraction * HASH_SPACE))
