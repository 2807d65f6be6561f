"""Typed configuration of the dataset pipeline, with YAML as its file form."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass
from typing import Any

import yaml


@dataclass(frozen=True)
class Separation:
    sampling_rate: int = 22_050
    max_duration_s: float = 30.0
    sources: int = 4


@dataclass(frozen=True)
class Analysis:
    sampling_rate: int = 48_000
    min_confidence: float = 0.2


@dataclass(frozen=True)
class Segmentation:
    segment_length_s: float = 5.0
    min_tail_s: float = 1.0
    confidence: float = 0.2
    dominance: float = 0.1
    label_match: str = "any"
    duplicate_source: str = "first"


@dataclass(frozen=True)
class Balance:
    enabled: bool = False
    method: str = "undersample"
    max_per_file: int | None = None
    min_per_class: int = 50


@dataclass(frozen=True)
class Mix:
    max_polyphony: int = 6
    replications: int = 5
    batch_rows: int = 100
    max_shift_ratio: float = 0.2
    signal_levels: tuple[int, ...] = tuple(range(-12, 1))
    noise_levels: tuple[int, ...] = tuple(range(-12, 13))
    mix_levels: tuple[int, ...] = tuple(range(-12, -5))
    test_share: float = 0.1
    validation_share: float = 0.1


@dataclass(frozen=True)
class Config:
    subset: str = "HSN"
    seed: int = 42
    limit: int | None = None
    separation: Separation = field(default_factory=Separation)
    analysis: Analysis = field(default_factory=Analysis)
    segmentation: Segmentation = field(default_factory=Segmentation)
    balance: Balance = field(default_factory=Balance)
    mix: Mix = field(default_factory=Mix)


def _value(kind: Any, value: Any) -> Any:
    # YAML has null for "none"; the words None and none in a file mean the same here, never a string
    if isinstance(value, str) and value.lower() == "none":
        return None
    return tuple(value) if isinstance(value, list) else value


def from_dict(kind: type, data: dict) -> Any:
    """A dataclass from nested mappings; unknown keys raise ValueError."""
    known = {f.name: f for f in fields(kind)}
    if extra := set(data) - set(known):
        raise ValueError(f"unknown settings {sorted(extra)} for {kind.__name__}")
    default = kind()
    out = {}
    for name, value in data.items():
        own = getattr(default, name)
        out[name] = from_dict(type(own), value) if is_dataclass(own) else _value(known[name].type, value)
    return kind(**out)


def load(path: str) -> Config:
    with open(path, encoding="utf-8") as f:
        return from_dict(Config, yaml.safe_load(f) or {})
