"""Mixtures: greedy assignment of segments to mixtures on metadata alone, and rendering of the sums.

Assignment is sequential inside a batch, so batches are bounded and run in parallel. Every draw comes
from the seed, the batch and the position, never from shared state.
"""

from __future__ import annotations

import hashlib
import random
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.config import Mix


class Cursor:
    """Values in shuffled order without repeats; when they run out they are shuffled again with the next seed."""

    def __init__(self, values, seed: int, reset: bool = True):
        self.values, self.seed, self.auto = list(values), seed, reset
        self._shuffle()

    def _shuffle(self) -> None:
        random.Random(self.seed).shuffle(self.values)
        self.at = 0

    def pop(self):
        """The next value; IndexError at the end unless the cursor starts again by itself."""
        if self.at >= len(self.values):
            if not self.auto or not self.values:
                raise IndexError("no value is left")
            self.seed += 1
            self._shuffle()
        self.at += 1
        return self.values[self.at - 1]


def batch_seed(seed: int, *parts) -> int:
    return int(hashlib.md5("|".join(map(str, (seed, *parts))).encode()).hexdigest()[:12], 16)


def assign_batch(files: list, seed: int, mix: Mix) -> list[tuple[int, int, int, int, float]]:
    """(row, mix, degree, place in the mixture, level dBFS) of the rows of a batch that come into a mixture.

    Rows are taken in order. A row whose file is in the mixture already waits for a later pass; an unfinished
    mixture carries over between passes. It ends when a pass places nothing; an unfinished mixture is dropped.
    """
    degrees = Cursor(range(1, mix.max_polyphony + 1), seed)
    levels = Cursor(mix.signal_levels, seed + 1)
    out, waiting, number = [], list(range(len(files))), 0
    degree, members = degrees.pop(), []
    while waiting:
        later = []
        for row in waiting:
            if any(files[m[0]] == files[row] for m in members):
                later.append(row)
                continue
            members.append((row, number, degree, len(members), 0.0 if not members else float(levels.pop())))
            if len(members) == degree:
                out += members
                number, degree, members = number + 1, degrees.pop(), []
        if len(later) == len(waiting):
            break
        waiting = later
    return out


def assign(batches: DataFrame, key: str, file: str, groups: list[str], position: str, seed: int, mix: Mix = Mix()) -> DataFrame:
    """Of rows with ``groups`` (a batch each) and ``position``: key, mix_idx, degree, place and the levels of each
    member and mixture. Only metadata is read."""
    kinds = ", ".join(f"{g} {batches.schema[g].dataType.simpleString()}" for g in groups)
    schema = f"{kinds}, {key} {batches.schema[key].dataType.simpleString()}, mix_idx int, degree int, place int, level_dbfs double, noise_dbfs double, mix_dbfs double"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(position, kind="stable").reset_index(drop=True)
        own = batch_seed(seed, *(rows[g].iloc[0] for g in groups))
        placed = assign_batch(rows[file].tolist(), own, mix)
        noise, level = Cursor(mix.noise_levels, own + 2), Cursor(mix.mix_levels, own + 3)
        count = placed[-1][1] + 1 if placed else 0
        levels = [(float(noise.pop()), float(level.pop())) for _ in range(count)]
        made = rows.iloc[[p[0] for p in placed]][[*groups, key]].reset_index(drop=True)
        for i, name in enumerate(("mix_idx", "degree", "place", "level_dbfs"), 1):
            made[name] = [p[i] for p in placed]
        made["noise_dbfs"] = [levels[p[1]][0] for p in placed]
        made["mix_dbfs"] = [levels[p[1]][1] for p in placed]
        return made

    return batches.select(*dict.fromkeys([*groups, key, file, position])).groupBy(*groups).applyInPandas(run, schema)


def gain(dbfs: float) -> float:
    return float(10 ** (dbfs / 20))


def level(x: np.ndarray, bounds: list | None = None, rate: int = 1) -> float:
    """RMS over the samples of the bounds, or of all without any. No samples: ValueError."""
    if bounds:
        x = np.concatenate([x[max(0, int(np.floor(b[0] * rate))) : min(len(x), int(np.ceil(b[1] * rate)))] for b in bounds])
    if not len(x):
        raise ValueError("no samples to measure")
    return float(np.sqrt(np.mean(np.asarray(x, float) ** 2)))


def shifted(x: np.ndarray, bounds: list, rate: int, length: int, ratio: float, seed: int) -> tuple[np.ndarray, list, int]:
    """The signal moved by up to ``ratio`` of its length, its bounds moved alike, and the samples moved. A shift that
    takes all bounds out of the mixture isn't made, and the bounds stay."""
    draw = random.Random(seed)
    by = draw.randint(0, int(len(x) * ratio)) * draw.choice((1, -1))
    seconds, end = by / rate, length / rate
    if not any(b[0] + seconds < end and b[1] + seconds > 0 for b in bounds):
        return x, bounds, 0
    out = np.zeros_like(x)
    if by >= 0:
        out[by:] = x[: len(x) - by]
    else:
        out[:by] = x[-by:]
    return out, [[b[0] + seconds, b[1] + seconds, *b[2:]] for b in bounds], by


def place(x: np.ndarray, bounds: list, level_dbfs: float, rate: int, length: int, ratio: float, seed: int) -> dict:
    """A member brought to its level (by the RMS inside its bounds), moved, and cut or padded to the mixture's length.
    A silent member stays silent."""
    rms = level(x, bounds, rate)
    norm = 1 / rms if rms > 0 else 0.0
    y, moved, _ = shifted(x * norm * gain(level_dbfs), bounds, rate, length, ratio, seed)
    y = np.pad(y[:length], (0, max(0, length - len(y))))
    return {"signal": y, "event_rms": rms, "norm_gain": norm, "gain": norm * gain(level_dbfs), "bounds": moved}


def mix_signals(members: list[np.ndarray], noise: np.ndarray, noise_dbfs: float, mix_dbfs: float) -> dict:
    """The sum of the members, with noise at its level, and that sum brought to the mixture's level. Silence stays silent."""
    length = len(members[0])
    if len(noise) < length:
        raise ValueError("the noise is shorter than the mixture")
    clean, noise = np.sum(members, axis=0), noise[:length]
    noise_rms = level(noise)
    noise_gain = gain(noise_dbfs) / noise_rms if noise_rms > 0 else 0.0
    whole = clean + noise * noise_gain
    mix_rms = level(whole)
    mix_gain = gain(mix_dbfs) / mix_rms if mix_rms > 0 else 0.0
    return {
        "mixed": whole * mix_gain, "clean": clean, "noise_rms": noise_rms, "noise_gain": noise_gain,
        "mix_rms": mix_rms, "mix_gain": mix_gain,
    }


RENDERED = (
    "mix_idx int, degree int, mixed array<double>, clean array<double>, noise_dbfs double, noise_rms double, noise_gain double, "
    "mix_dbfs double, mix_rms double, mix_gain double, event_rms array<double>, norm_gain array<double>, "
    "relative_dbfs array<double>, gain array<double>, shifted_bounds array<array<array<double>>>"
)


#: Mixtures that are rendered in one group: enough to spread its cost, few enough to hold their signals.
RENDERED_AT_ONCE = 8


def render(members: DataFrame, groups: list[str], length: int, rate: int, seed: int, ratio: float) -> DataFrame:
    """Of member rows (groups, mix_idx, degree, place, level_dbfs, noise_dbfs, mix_dbfs, signal, bounds, noise): one row
    per mixture. bounds: [start s, end s, ...] of a member's calls; without any it is measured whole and never moved.
    Only the first member's noise is used, so only that moves."""
    kinds = ", ".join(f"{g} {members.schema[g].dataType.simpleString()}" for g in groups)
    names = [*groups, *(c.split()[0] for c in RENDERED.split(", "))]

    def mixture(rows: list[dict]) -> dict:
        first = rows[0]
        placed = []
        for r in rows:
            own = batch_seed(seed, *(first[g] for g in groups), r["mix_idx"], r["place"])
            placed.append(place(r["signal"], r["bounds"] or [], r["level_dbfs"], rate, length, ratio, own))
        made = mix_signals([p["signal"] for p in placed], first["noise"], first["noise_dbfs"], first["mix_dbfs"])
        values = {g: first[g] for g in [*groups, "mix_idx", "degree", "noise_dbfs", "mix_dbfs"]} | made
        values |= {k: [p[k] for p in placed] for k in ("event_rms", "norm_gain", "gain")}
        return values | {"relative_dbfs": [r["level_dbfs"] for r in rows], "shifted_bounds": [p["bounds"] for p in placed]}

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("mix_idx", "ascending"), ("place", "ascending")])
        plain = table.drop_columns(["signal", "noise"]).to_pylist()
        for i, row in enumerate(plain):
            row["signal"] = np.asarray(table.column("signal")[i].values, float)
            noise = table.column("noise")[i]
            row["noise"] = np.asarray(noise.values, float) if noise.is_valid else None
        made = [mixture(list(rows)) for _, rows in groupby(plain, key=lambda r: r["mix_idx"])]
        return pa.table({n: [m[n] for m in made] for n in names}, schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(f"{kinds}, {RENDERED}"))
    wanted = [*groups, "mix_idx", "degree", "place", "level_dbfs", "noise_dbfs", "mix_dbfs", "signal", "bounds"]
    moved = members.select(*wanted, F.when(F.col("place") == 0, F.col("noise")).alias("noise"))
    return moved.groupBy(*groups, F.floor(F.col("mix_idx") / RENDERED_AT_ONCE)).applyInArrow(run, f"{kinds}, {RENDERED}")
