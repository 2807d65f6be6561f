"""Deterministic draws from md5, the same in any engine that has md5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_key(seed: int | Column, *parts: Column) -> Column:
    """A key that orders rows at random, one order per seed."""
    first = F.lit(str(seed)) if isinstance(seed, int) else seed.cast("string")
    return F.md5(F.concat_ws("|", first, *(p.cast("string") for p in parts)).cast("binary"))


def draw(seed: int, n: Column, *parts: Column) -> Column:
    """An integer in [0, n) from 32 bits of the key."""
    return F.conv(F.substring(order_key(seed, *parts), 1, 8), 16, 10).cast("bigint") % n
