"""Command line: ``python -m addrloom.cli --consumer a.csv --business b.csv --parcel c.xlsx --output out``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from addrloom.functions import rules as R
from addrloom.plans.report import run_to_folder


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Consolidate overlapping mailing lists.")
    for kind in ("consumer", "business", "parcel"):
        p.add_argument(f"--{kind}", help=f"the {kind} feed: .csv, .xlsx or .parquet")
    p.add_argument("--output", default="output", help="folder for the result and the reports")
    p.add_argument("--threshold", type=float, default=R.ADDRESS_RATIO, help="least similarity of two addresses")
    p.add_argument("--unit-mode", choices=("reference", "strict"), default="reference")
    a = p.parse_args(args)
    if not (a.consumer or a.business or a.parcel):
        p.error("give at least one feed")
    spark = SparkSession.builder.appName("addrloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    done = run_to_folder(spark, a.output, consumer=a.consumer, business=a.business, parcel=a.parcel, least=a.threshold, unit_mode=a.unit_mode)
    return int(done.status == "FAIL")


if __name__ == "__main__":
    sys.exit(main())
