"""Command line for spark-submit: layers, direct, reprocess and sort jobs."""

from __future__ import annotations

import argparse
import logging
from dataclasses import fields

from pyspark.sql import SparkSession

from covermonth.plans import layers


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="covermonth")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("layers", "direct"):
        job = jobs.add_parser(name)
        job.add_argument("--core", help="folder with one subfolder of CSV files per delivery")
        job.add_argument("--claims", help="folder of claims workbooks")
        job.add_argument("--reports", help="folder for the reports")
        job.add_argument("--sources", nargs="+", default=layers.ALL_SOURCES,
                         choices=layers.ALL_SOURCES)
        job.add_argument("--run-date", help="yyyy-mm-dd, default today")
        job.add_argument("--always-clean", action="store_true",
                         help="repair the quoting of every policy line")
        job.add_argument("--quoted-newlines", action="store_true",
                         help="quoted fields of the policy files hold line breaks")
        job.add_argument("--fail-fast", action="store_true",
                         help="fail at a policy line with too few or too many fields")
        job.add_argument("--date-mode", default="lenient", choices=("lenient", "strict"))
        job.add_argument("--year-pivot", type=int, default=layers.DEFAULT_YEAR_PIVOT)
        job.add_argument("--blank-ruc-is-null", action="store_true")
        job.add_argument("--drop-optional", action="store_true",
                         help="reports without PARENTESCO and FI")
        job.add_argument("--by-log", action="store_true", default=None,
                         help="publish by a commit log (always done on object stores)")
        if name == "layers":
            job.add_argument("--lake", required=True, help="folder of the layer tables")
            job.add_argument("--layers", nargs="+", default=layers.ALL_LAYERS,
                             choices=layers.ALL_LAYERS)
            job.add_argument("--keep-rejects", action="store_true",
                             help="with strict dates: a table of the policies that break them")
            job.add_argument("--fmt", default="parquet", help="format of the layer tables")
    for name in ("reprocess", "sort"):
        job = jobs.add_parser(name)
        job.add_argument("--reports", required=True)
        job.add_argument("--target", required=True)
        if name == "sort":
            job.add_argument("--lookup", action="store_true",
                             help="prepare the report for looking up documents")
    return parser


def main(arguments: list[str] | None = None) -> None:
    options = _parser().parse_args(arguments)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = SparkSession.builder.appName(f"covermonth-{options.job}").getOrCreate()
    if options.job == "reprocess":
        result = layers.reprocess_reports(spark, options.reports, options.target)
    elif options.job == "sort":
        result = layers.sort_reports(spark, options.reports, options.target,
                                     lookup=options.lookup)
    else:
        paths = layers.Paths(
            options.core, options.claims, getattr(options, "lake", None), options.reports)
        sources = tuple(options.sources)
        chosen = layers.Options(**{
            f.name: getattr(options, f.name) for f in fields(layers.Options)
            if hasattr(options, f.name)})
        if options.job == "layers":
            result = layers.run_layers(
                spark, paths, tuple(options.layers), sources, options.run_date, chosen)
        else:
            result = layers.run_direct(spark, paths, sources, options.run_date, chosen)
    logging.getLogger(__name__).info("rows: %s", result)


if __name__ == "__main__":
    main()
