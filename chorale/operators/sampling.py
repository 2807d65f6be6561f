"""Sampling, balancing, splitting and replication; every draw is an md5 key of a seed and the row's id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.functions.hashing import draw, order_key
from chorale.operators.ranking import ranked


def no_label(code: Column, codes: Column, secondary: Column) -> Column:
    """No code, an empty (not a null) list of codes, and no secondary label."""
    return code.isNull() & F.coalesce(F.size(codes) == 0, F.lit(False)) & codes.isNotNull() & secondary.isNull()


def half_sample(df: DataFrame, key: str, seed: int) -> DataFrame:
    """``df`` with ``sampled``: true for exactly half of the rows, rounded down."""
    out = ranked(df, [], [order_key(seed, F.col(key)), F.col(key)])
    return out.withColumn("sampled", F.col("rank") <= F.floor(F.col("rank_count") / 2)).drop("rank", "rank_count")


def noise_and_test(df: DataFrame, unlabelled: Column, key: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """Half of the unlabelled rows as noise, and all rows but those as test."""
    noise = half_sample(df.where(unlabelled).select(key), key, seed).where("sampled").select(key)
    return df.join(noise, key, "left_semi"), df.join(noise, key, "left_anti")


def frequent_classes(df: DataFrame, label: str, least: int) -> tuple[DataFrame, DataFrame]:
    """(class, n) of the classes with at least ``least`` rows, and of the others."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least), counts.where(F.col("n") < least)


#: Numbers of one array when rows are numbered.
NUMBERS = 1 << 16


def numbered(df: DataFrame, n: Column, name: str) -> DataFrame:
    """Each row ``n`` times, with ``name`` from 0. Runs of NUMBERS are dealt before they are written out, so that
    neither one array nor one task holds all of a row's numbers."""
    runs = df.withColumn("_n_rows", n.cast("bigint")).where("_n_rows > 0")
    runs = runs.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n_rows") - 1) / NUMBERS))))
    first = F.col("_run") * NUMBERS
    return (
        runs.repartition("_run", *df.columns)
        .withColumn(name, F.explode(F.sequence(first, F.least(first + NUMBERS, F.col("_n_rows")) - 1)))
        .drop("_n_rows", "_run")
    )


def undersample(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    """As many rows of each class as the smallest class has, without replacement."""
    by = ranked(df, [F.col(label)], [order_key(seed, F.col(key)), F.col(key)])
    target = df.groupBy(label).count().agg(F.min("count").alias("_target"))
    return by.join(F.broadcast(target)).where(F.col("rank") <= F.col("_target")).drop("rank", "rank_count", "_target")


def oversample(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    """As many rows of each class as the largest class has, drawn with replacement; ``draw`` numbers a class's draws."""
    by = ranked(df, [F.col(label)], [F.col(key)])
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    target = counts.agg(F.max("_n").alias("_target"))
    wanted = numbered(counts.join(F.broadcast(target)), F.col("_target"), "draw")
    drawn = wanted.select(label, "draw", (draw(seed, F.col("_n"), F.col(label), F.col("draw")) + 1).alias("rank"))
    return drawn.join(by.drop("rank_count"), [label, "rank"]).select(*df.columns, "draw")


def capped_sample(df: DataFrame, key: str, label: str, file: str, seed: int, per_file: int | None, target: int | None = None) -> DataFrame:
    """Of each class at most ``per_file`` rows of a file (None: all), and ``target`` rows of what is left (None: as many as
    the largest class of ``df`` has): without replacement where there are enough, else drawn with replacement.
    ``draw`` numbers a class's rows from 0."""
    if target is None:
        target = df.groupBy(label).count().agg(F.max("count")).first()[0] or 0
    if per_file is None:
        pool = df
    else:
        pool = ranked(df, [F.col(label), F.col(file)], [order_key(seed, F.col(key)), F.col(key)], "in_file").where(F.col("in_file") <= per_file)
    pool = ranked(pool.select(*df.columns), [F.col(label)], [order_key(seed + 1, F.col(key)), F.col(key)], "at")
    enough = pool.where((F.col("at_count") >= target) & (F.col("at") <= target)).select(*df.columns, (F.col("at") - 1).alias("draw"))
    small = pool.where(F.col("at_count") < target).groupBy(label).agg(F.max("at_count").alias("_n"))
    wanted = numbered(small, F.lit(target), "draw")
    drawn = wanted.select(label, "draw", (draw(seed, F.col("_n"), F.col(label), F.col("draw")) + 1).alias("at"))
    again = drawn.join(pool.drop("at_count"), [label, "at"]).select(*df.columns, "draw")
    return enough.unionByName(again)


def balance(df: DataFrame, key: str, label: str, file: str, seed: int, method: str, per_file: int | None, least: int) -> DataFrame:
    """The classes with at least ``least`` rows, balanced by the method: undersample, oversample or controlled_oversample.
    A row that is drawn more than once is there as often, told apart by ``draw`` (0 throughout if undersampled)."""
    return balance_and_removed(df, key, label, file, seed, method, per_file, least)[0]


def balance_and_removed(
    df: DataFrame, key: str, label: str, file: str, seed: int, method: str, per_file: int | None, least: int
) -> tuple[DataFrame, DataFrame]:
    """``balance``, and (class, n) of the classes that were removed because they have too few rows."""
    kept, removed = frequent_classes(df, label, least)
    df = df.join(kept.select(label), label, "left_semi")
    if method == "undersample":
        return undersample(df, key, label, seed).withColumn("draw", F.lit(0).cast("bigint")), removed
    if method == "oversample":
        return oversample(df, key, label, seed), removed
    if method == "controlled_oversample":
        return capped_sample(df, key, label, file, seed, per_file), removed
    raise ValueError(f"method {method!r} is none of undersample, oversample, controlled_oversample")


def split(df: DataFrame, key: str, test: float, validation: float, order: Column | None = None) -> DataFrame:
    """``df`` with ``split``: train, validation and test as contiguous runs of the order (the key without one).
    Test has the rounded-up share of all rows, validation the rounded-up share of all of the rest."""
    by = ranked(df, [], [*([order] if order is not None else []), F.col(key)])
    n = F.col("rank_count")
    n_test = F.ceil(F.round(n * test, 9))
    n_validation = F.ceil(F.round((n - n_test) * (validation / (1 - test)), 9))
    name = (
        F.when(F.col("rank") <= n - n_test - n_validation, "train").when(F.col("rank") <= n - n_test, "validation").otherwise("test")
    )
    return by.withColumn("split", name).drop("rank", "rank_count")


def split_by_file(df: DataFrame, file: str, seed: int, test: float, validation: float) -> DataFrame:
    """``df`` with ``split``, all rows of a file in one."""
    at = draw(seed, F.lit(1_000_000), F.col(file)) / 1_000_000
    return df.withColumn("split", F.when(at < test, "test").when(at < test + validation, "validation").otherwise("train"))


def split_overlap(df: DataFrame, *keys: str) -> DataFrame:
    """The keys found in more than one split, with the number of splits."""
    return df.groupBy(*keys).agg(F.count_distinct("split").cast("long").alias("n_splits")).where("n_splits > 1")


def replicate(df: DataFrame, key: str, epochs: int, seed: int) -> DataFrame:
    """``df`` ``epochs`` times, each epoch in an order of its own; ``position`` from 0 over all epochs."""
    copies = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    out = ranked(copies, [], [F.col("epoch"), order_key(F.lit(seed) + F.col("epoch"), F.col(key)), F.col(key)])
    return out.withColumn("position", F.col("rank") - 1).drop("rank", "rank_count")


def batches(df: DataFrame, order: list[Column], rows: int, groups: list[Column] | None = None) -> DataFrame:
    """``df`` with ``batch_idx``: runs of ``rows`` rows of the order, in each group by itself."""
    out = ranked(df, groups or [], order)
    return out.withColumn("batch_idx", F.floor((F.col("rank") - 1) / rows)).drop("rank", "rank_count")
