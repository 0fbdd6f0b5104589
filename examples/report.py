"""Every feature of the absence application as report files, from one CSV.

    python examples/report.py ABSENCE_CSV OUT_DIR --areas Leeds York --period 2017/18 --category Primary

The CSV is loaded once into a period-partitioned table under OUT_DIR; each
feature is then one Spark query on it, written as Parquet (or CSV with
--csv) to OUT_DIR/<feature>.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tierstat import operators as op  # noqa: E402
from tierstat.plans import absence_location_school, compare_report, region_performance  # noqa: E402
from tierstat.sources import ingest_table  # noqa: E402


def reports(table, areas: list[str], period: str, category: str) -> dict:
    perf = region_performance(table)
    location = absence_location_school(table, period)
    return {
        "menus": op.menus(table),
        "enrolments": op.with_formats(op.enrolment_series_multi(table, areas), thousands=["enrolments"]),
        "medical_absence": op.with_formats(op.medical_absence_total(table, category, period), thousands=["total"]),
        "unauthorised_by_la": op.unauthorised_by_la(table, period),
        "unauthorised_by_region": op.unauthorised_by_region(table, period),
        "top3_authorised_reasons": op.top_reasons(table, 3),
        "compare": compare_report(table, areas[0], areas[-1], period),
        "region_series": perf.series,
        "region_ranks": perf.ranks,
        "region_ranking": perf.ranking,
        "absence_location_school": location.grid,
    }


def main(argv: list[str] | None = None) -> dict[str, str]:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("csv")
    ap.add_argument("out")
    ap.add_argument("--areas", nargs="+", required=True)
    ap.add_argument("--period", required=True)
    ap.add_argument("--category", required=True)
    ap.add_argument("--csv-out", action="store_true", help="write CSV instead of Parquet")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("absence-reports").getOrCreate()
    table = ingest_table(spark, args.csv, os.path.join(args.out, "table"))
    written = {}
    for name, df in reports(table, args.areas, args.period, args.category).items():
        written[name] = op.write_report(df, os.path.join(args.out, name), "csv" if args.csv_out else "parquet")
    return written


if __name__ == "__main__":
    for feature, path in main().items():
        print(f"{feature}: {path}")
