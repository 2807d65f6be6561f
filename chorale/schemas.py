"""Schemas of the pipeline's tables. Arrays of samples stay apart from the scalar columns that filters push down to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def struct(**columns: DataType) -> StructType:
    return StructType([StructField(n, t) for n, t in columns.items()])


DECODED = struct(array=ArrayType(FloatType()), sampling_rate=LongType())
ENCODED = struct(bytes=BinaryType(), path=StringType())
INTERVAL = struct(start=DoubleType(), end=DoubleType())
BOUND = struct(t_start=DoubleType(), t_end=DoubleType(), f_low=DoubleType(), f_high=DoubleType())
DETECTION = struct(
    common_name=StringType(), scientific_name=StringType(), label=StringType(),
    confidence=FloatType(), start_time=FloatType(), end_time=FloatType(),
)
SOURCE = struct(audio=DECODED, detections=ArrayType(DETECTION))

RECORDINGS = struct(
    recording_id=StringType(), audio=DECODED, filepath=StringType(), n_samples=LongType(), sampling_rate=LongType(),
    ebird_code=LongType(), ebird_code_multilabel=ArrayType(LongType()), ebird_code_secondary=ArrayType(StringType()),
    start_time=DoubleType(), end_time=DoubleType(),
)
SEGMENTS = struct(
    segment_id=StringType(), audio=DECODED, time_freq_bounds=ArrayType(ArrayType(FloatType())), birdset_code=LongType(),
    ebird_code=StringType(), scientific_name=StringType(), common_name=StringType(),
    original_birdset_subset=StringType(), original_file=StringType(),
)
MIXTURES = struct(
    id=StringType(), audio=ENCODED, no_noise_audio=ENCODED, polyphony_degree=IntegerType(),
    birdset_code_multilabel=ArrayType(IntegerType()), noise_file=StringType(), noise_orig_rms=FloatType(),
    noise_dBFS=FloatType(), noise_norm_gain=FloatType(), noise_gain=FloatType(), mix_orig_rms=FloatType(),
    mix_dBFS=FloatType(), mix_gain=FloatType(), raw_files_event_rms=ArrayType(FloatType()),
    raw_files_norm_gain=ArrayType(FloatType()), raw_files_relative_dBFS=ArrayType(FloatType()),
    raw_files_gain=ArrayType(FloatType()), shifted_time_freq_bounds=ArrayType(ArrayType(ArrayType(FloatType()))),
)
CODE_MAP = struct(subset=StringType(), birdset_code=IntegerType(), ebird_code=StringType())
TAXONOMY = struct(SPECIES_CODE=StringType(), PRIMARY_COM_NAME=StringType(), SCI_NAME=StringType())


def require(df: DataFrame, *names: str) -> DataFrame:
    """``df``, or ValueError if columns are missing."""
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
    return df


def flattened(prefix: str, schema: StructType) -> StructType:
    """Each column as a list column ``prefix_name``, a struct's fields as ``prefix_name_field``."""
    out = []
    for f in schema.fields:
        if isinstance(f.dataType, StructType):
            out += [StructField(f"{prefix}_{f.name}_{g.name}", ArrayType(g.dataType)) for g in f.dataType.fields]
        else:
            out.append(StructField(f"{prefix}_{f.name}", ArrayType(f.dataType)))
    return StructType(out)
