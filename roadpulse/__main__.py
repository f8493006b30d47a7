"""Run stages from the command line: ``spark-submit`` this file, or ``python -m roadpulse``.

Locations, topic, box and poll seconds come from the environment (see ``FeedConfig.from_env``).
``--root`` places every location itself and refuses variables that would place one elsewhere.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Mapping, Sequence

from roadpulse.config import ENV_SETTINGS, FeedConfig, locations_under
from roadpulse.session import get_spark
from roadpulse.streaming import STAGES, run_stages


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="roadpulse", description=__doc__)
    parser.add_argument("--skip", action="append", choices=STAGES, default=[])
    parser.add_argument(
        "--transport", choices=("kafka", "files"), help="kafka; below --root files, if not given"
    )
    parser.add_argument("--table-format", choices=("parquet", "delta"), default="parquet")
    parser.add_argument("--root", help="put every location below this folder")
    duration = parser.add_mutually_exclusive_group()
    duration.add_argument("--keep-running-seconds", type=float, help="stop after so long")
    duration.add_argument("--drain", action="store_true", help="read what is there and return")
    return parser.parse_args(argv)


def configured(given: argparse.Namespace, env: Mapping[str, str] | None = None) -> FeedConfig:
    env = os.environ if env is None else env
    chosen = {"table_format": given.table_format}
    if not given.root:
        return FeedConfig.from_env(env, transport=given.transport or "kafka", **chosen)
    places = locations_under(given.root)
    twice = sorted(name for name, setting in ENV_SETTINGS.items() if setting in places and name in env)
    if twice:
        raise SystemExit(f"--root places every location, but {', '.join(twice)} is set too")
    return FeedConfig.from_env(env, transport=given.transport or "files", **chosen, **places)


def main(argv: Sequence[str] | None = None) -> None:
    given = arguments(argv)
    config = configured(given)
    spark = get_spark("roadpulse", config=config)
    run_stages(
        spark,
        config,
        [stage for stage in STAGES if stage not in given.skip],
        keep_running_seconds=given.keep_running_seconds,
        drain=given.drain,
    )


if __name__ == "__main__":
    main()
