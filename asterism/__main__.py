"""spark-submit entry point: load a landing folder into a warehouse folder."""

from __future__ import annotations

import argparse
import json
import logging
from datetime import date, datetime

from pyspark.sql import SparkSession

from asterism.plans.run import run
from asterism.schemas import KEY_TYPES
from asterism.sources.calendar import CALENDAR_END, CALENDAR_START


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="asterism", description=__doc__)
    parser.add_argument("landing", help="folder with posts/, users/ and comments/")
    parser.add_argument("warehouse", help="folder of the tables")
    parser.add_argument("--run-ts", type=datetime.fromisoformat, help="default: now")
    parser.add_argument("--layout", choices=("lines", "array"), default="lines")
    parser.add_argument("--id-type", choices=tuple(KEY_TYPES), default="int")
    parser.add_argument("--keep", action="store_true", help="load over the current tables")
    parser.add_argument("--calendar-start", type=date.fromisoformat, default=CALENDAR_START)
    parser.add_argument("--calendar-end", type=date.fromisoformat, default=CALENDAR_END)
    parser.add_argument("--buckets", type=int, help="buckets of the staged posts")
    parser.add_argument("--verify", action="store_true", help="query all constraints")
    options = parser.parse_args(arguments)

    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("asterism").getOrCreate()
    counts = run(
        spark,
        options.landing,
        options.warehouse,
        options.run_ts,
        layout=options.layout,
        id_type=options.id_type,
        refresh=not options.keep,
        calendar=(options.calendar_start, options.calendar_end),
        buckets=options.buckets,
        verify=options.verify,
    )
    print(json.dumps(counts))


if __name__ == "__main__":
    main()
