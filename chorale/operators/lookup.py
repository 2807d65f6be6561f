"""Lookups of codes and names. The dimensions are fixed lists of species, a few thousand rows at most."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.functions.names import normalize_name


def first_match(taxonomy: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row for each key in lower case: the first by ``order``."""
    cols = [c for c in taxonomy.columns if c not in order]
    best = F.min(F.struct(*order, F.struct(*cols).alias("_row"))).alias("_best")
    return taxonomy.groupBy(F.lower(F.col(key)).alias("_key")).agg(best).select("_key", *(F.col(f"_best._row.{c}").alias(c) for c in cols))


def code_names(codes: DataFrame, taxonomy: DataFrame, order: list[str]) -> DataFrame:
    """The species dimension: subset, birdset_code, ebird_code, common_name and scientific_name, normalised.
    Codes that the taxonomy lacks have null names."""
    named = first_match(taxonomy, "SPECIES_CODE", order)
    return codes.join(named, F.lower("ebird_code") == F.col("_key"), "left").select(
        "subset", "birdset_code", "ebird_code",
        normalize_name(F.col("PRIMARY_COM_NAME")).alias("common_name"), normalize_name(F.col("SCI_NAME")).alias("scientific_name"),
    )


def lookup(df: DataFrame, dimension: DataFrame, on: Column, strict: bool = True) -> DataFrame:
    """Inner join with a dimension. strict: ValueError names how many rows have no match."""
    if strict and (lost := df.join(dimension, on, "left_anti").count()):
        raise ValueError(f"{lost} rows have no match")
    return df.join(dimension, on)


def membership(codes: Column, names: Column, detected: Column, match: str) -> Column:
    """Whether the detected name is that of the ``first`` code, or of ``any``; ``names`` maps codes to names."""
    held = F.slice(codes, 1, 1) if match == "first" else codes
    return F.coalesce(F.exists(held, lambda c: F.element_at(names, c) == detected), F.lit(False))


def same_species(common: Column, scientific: Column, other_common: Column, other_scientific: Column) -> Column:
    """Whether both normalised names agree; null counts as no agreement."""
    same = (normalize_name(common) == normalize_name(other_common)) & (normalize_name(scientific) == normalize_name(other_scientific))
    return F.coalesce(same, F.lit(False))
