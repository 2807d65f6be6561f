"""Pairing batches of mixtures with windows of background noise, by index and not by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.functions.hashing import order_key
from chorale.operators.ranking import ranked


def window_rows(batch_rows: int, max_polyphony: int) -> int:
    """Noise rows that a batch may need: ``max_polyphony`` for every full cycle of polyphony degrees."""
    cycle = max_polyphony * (max_polyphony + 1) // 2
    return -(-batch_rows // cycle) * max_polyphony


def enlarge(noise: DataFrame, key: str, least: int, seed: int) -> DataFrame:
    """``noise`` with ``noise_idx`` from 0: doubled until there are ``least`` rows, each copy in an order of its own."""
    n = noise.count()
    if n == 0:
        raise ValueError("there is no noise to pair with")
    copies = 1
    while n * copies < least:
        copies *= 2
    out = noise.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    out = ranked(out, [], [F.col("_copy"), order_key(F.lit(seed) + F.col("_copy"), F.col(key)), F.col(key)])
    return out.withColumn("noise_idx", F.col("rank") - 1).withColumnRenamed("rank_count", "n_noise").drop("rank", "_copy")


def noise_index(batch_idx: Column, mix_idx: Column, n_noise: Column, rows: int) -> Column:
    """Window after window, from the first again where the next would overrun."""
    return F.pmod(batch_idx, F.greatest(F.floor(n_noise / rows), F.lit(1))) * rows + mix_idx
