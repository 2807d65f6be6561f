"""Command line: python -m chorale.cli STAGE --config FILE --input DIR --output DIR."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable

from chorale.config import Config, load
from chorale.plans import stages
from chorale.session import build
from chorale.sources import readers, sinks


def factory(name: str) -> Callable:
    """The callable that ``module:attribute`` names; executors import it too."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="chorale", description=__doc__)
    parser.add_argument("stage", choices=["ingest", "noise", "separate", "analyse", "segment", "mix", "publish"])
    parser.add_argument("--config")
    parser.add_argument("--input", required=True)
    parser.add_argument("--noise", help="noise table, for mix")
    parser.add_argument("--model", help="module:factory of the separator or detector")
    parser.add_argument("--recordings", help="recordings table, for segment")
    parser.add_argument("--species", help="species table, for segment")
    parser.add_argument("--output", required=True)
    parser.add_argument("--key", default="recording_id")
    parser.add_argument("--rate", type=int, default=22_050)
    own = parser.parse_args(args)
    needs = {"separate": ["model"], "analyse": ["model"], "segment": ["recordings", "species"], "mix": ["noise"]}
    if missing := [n for n in needs.get(own.stage, []) if not getattr(own, n)]:
        parser.error(f"{own.stage} needs --{' --'.join(missing)}")
    config = load(own.config) if own.config else Config()
    spark = build(f"chorale-{own.stage}")
    df = readers.table(spark, own.input)
    if own.stage == "ingest":
        out = readers.limited(df, own.key, config.limit)
        sinks.replace(out, own.output)
    elif own.stage == "noise":
        noise, test = stages.noise_and_test(df, config)
        sinks.write(noise, f"{own.output}/noise")
        sinks.write(test, f"{own.output}/test")
        return
    elif own.stage == "separate":
        sinks.replace(stages.separate(stages.truncate(df, own.rate, config), own.rate, factory(own.model)), own.output)
    elif own.stage == "analyse":
        sinks.replace(stages.analyse(df, own.rate, factory(own.model), config), own.output)
    elif own.stage == "segment":
        recordings, species = (readers.table(spark, p) for p in (own.recordings, own.species))
        sinks.replace(stages.segments(recordings, df, species, own.rate, config), own.output)
    elif own.stage == "mix":
        out = stages.encoded(stages.mixtures(df, readers.table(spark, own.noise), own.rate, config), own.rate)
        sinks.replace(out, own.output, split="split")
    else:
        sinks.publish(df, own.output, config.subset, config.balance.enabled)
        return
    written = readers.table(spark, own.output)
    scalars = [c for c, kind in written.dtypes if not kind.startswith(("array", "struct", "binary", "map"))]
    sinks.write_manifest(spark, f"{own.output}.manifest.json", sinks.manifest(written, scalars, stage=own.stage))


if __name__ == "__main__":
    main()
