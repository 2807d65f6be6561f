"""Names, paths and labels as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_name(name: Column) -> Column:
    """Without white space at the ends, in lower case, spaces as underscores."""
    bare = F.regexp_replace(F.regexp_replace(name, r"^\s+", ""), r"\s+$", "")
    return F.replace(F.lower(bare), F.lit(" "), F.lit("_"))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """The base name up to its last dot; a leading dot is part of the stem."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def label(scientific: Column, common: Column) -> Column:
    """Both names in one label; null if either is."""
    return F.concat(scientific, F.lit(", "), common)


def output_path(directory: Column, path: Column, details: Column) -> Column:
    return F.concat(directory, stem(path), F.lit("_"), details, F.lit(".wav"))
