"""Scans: tables by schema, code maps, taxonomies, splits and encoded audio."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chorale import schemas
from chorale.functions import codec, dsp

SPLITS = ("train", "validation", "test")


def table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet table; with a schema its columns and types are forced, so that a missing one is null and not an error."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def with_empty(df: DataFrame, name: str, kind: str) -> DataFrame:
    """``df`` with an empty array column of a type given as DDL, such as ``array<struct<a:int>>``."""
    return df.withColumn(name, F.array().cast(kind))


def limited(df: DataFrame, key: str, n: int | None) -> DataFrame:
    """The first ``n`` rows by key; all without a limit."""
    return df if n is None else df.orderBy(key).limit(n)


def valid_splits(spark: SparkSession, root: str, schema: StructType | None = None) -> dict[str, DataFrame]:
    """The splits under ``root/split=...`` that hold rows; ValueError if none does."""
    whole = table(spark, root, schema)
    parts = {s: whole.where(F.col("split") == s).drop("split") for s in SPLITS}
    found = {s: df for s, df in parts.items() if not df.isEmpty()}
    if not found:
        raise ValueError(f"no split under {root} holds rows")
    return found


def code_map(spark: SparkSession, path: str, subset: str) -> DataFrame:
    """(subset, birdset_code, ebird_code) from JSON files of the form {"id2label": {"0": ...}, ...}."""
    text = spark.read.text(path, wholetext=True)
    labels = F.from_json(F.get_json_object("value", "$.id2label"), "map<string,string>")
    pairs = text.select(F.explode(labels).alias("code", "label"))
    return pairs.select(F.lit(subset).alias("subset"), F.col("code").cast("int").alias("birdset_code"), F.col("label").alias("ebird_code"))


def taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """The taxonomy's columns, and ``position``, the order of its rows, which decides between equal codes."""
    rows = spark.read.csv(path, header=True).select(*schemas.TAXONOMY.fieldNames())
    order = Window.partitionBy(F.lower("SPECIES_CODE")).orderBy(F.monotonically_increasing_id())
    return rows.withColumn("position", F.row_number().over(order))


def audio_files(spark: SparkSession, path: str, rate: int, pattern: str = "*.{wav,flac,WAV,FLAC}") -> DataFrame:
    """filepath, samples at ``rate``, sampling_rate and n_samples of the files under a path whose names match."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            read = [codec.decode(b) for b in part["content"]]
            out = [dsp.resample(x, own, rate).astype("float32") for x, own in read]
            yield pd.DataFrame({"filepath": part["path"], "samples": out, "sampling_rate": rate, "n_samples": [len(x) for x in out]})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", "content").mapInPandas(run, "filepath string, samples array<float>, sampling_rate long, n_samples long")


def wav_files(spark: SparkSession, path: str, rate: int) -> DataFrame:
    return audio_files(spark, path, rate, "*.wav")
