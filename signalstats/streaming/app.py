"""The streaming job as an application: ``spark-submit ... app.py config.json``.

Reads events from the configured topic, writes aggregate rows to another, and
starts again from the checkpoint after a failure. The configuration is JSON, or
YAML where that package is installed.
"""

from __future__ import annotations

import json
import pathlib
import sys

from signalstats.model import JobConfig
from signalstats.session import session_builder
from signalstats.streaming.pipeline import run_job
from signalstats.streaming.runner import run_forever


def load_config(path: str) -> JobConfig:
    text = pathlib.Path(path).read_text()
    if path.endswith((".yaml", ".yml")):
        import yaml

        return JobConfig.from_mapping(yaml.safe_load(text))
    return JobConfig.from_mapping(json.loads(text))


def main(arguments: list[str]) -> int:
    if not arguments:
        print("usage: app.py <configuration file>", file=sys.stderr)
        return 2
    config = load_config(arguments[0])
    spark = session_builder(config.app_name, **{k: str(v) for k, v in config.spark_conf.items()}).getOrCreate()
    run_forever(spark, lambda: run_job(spark, config))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
