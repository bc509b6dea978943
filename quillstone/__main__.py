"""Command line: python -m quillstone --config config.yaml"""

from __future__ import annotations

import argparse
import logging
import os
import sys

from quillstone.config import load_config
from quillstone.session import session
from quillstone.stages import LOGS, run_pipeline, write_error_log


def parse_args(args: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="quillstone", description="Texts to de-duplicated topic volumes")
    p.add_argument("--config", default="config.yaml", help="settings file (default: config.yaml)")
    p.add_argument("--only-stage", choices=["all", "extract", "synthesize"], default="all", help="run one stage only")
    p.add_argument("--full-resync", action="store_true", help="synthesize anew, without the caches of earlier runs")
    return p.parse_args(args)


def main(args: list[str] | None = None) -> int:
    """0, 1 after an error, 130 after an interrupt; errors are logged in the output folder, or beside the settings."""
    given = parse_args(args)
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    spark, config = session(), None
    try:
        config = load_config(given.config)
        run_pipeline(spark, config, given.only_stage, given.full_resync)
        return 0
    except BaseException as e:
        folder = f"{config.output_dir}/{LOGS}" if config else os.path.join(os.path.dirname(os.path.abspath(given.config)), LOGS)
        name = write_error_log(spark, folder, given.config, given.only_stage, e)
        logging.error("%s; see %s/%s", e, folder, name)
        return 130 if isinstance(e, KeyboardInterrupt) else 1


if __name__ == "__main__":
    sys.exit(main())
