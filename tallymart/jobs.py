"""The jobs, as functions and from a command line (see ``job.py`` beside the package)."""

from __future__ import annotations

import argparse
from collections.abc import Collection
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tallymart.plans import dashboard
from tallymart.plans.load import load_star
from tallymart.plans.publish import ENFORCED, publish, write_clean_audited
from tallymart.plans.star import build_clean, build_star
from tallymart.plans.totals import with_summaries
from tallymart.rules import DEFAULT_RULES, Rules
from tallymart.session import session
from tallymart.sources.raw import (
    RawTables,
    Staged,
    read_raw_csv,
    read_raw_parquet,
    stage_raw,
    stage_raw_csv,
)
from tallymart.sources.shared import remove_shared
from tallymart.sources.star import read_clean, read_warehouse, write_clean


def _raw(spark: SparkSession, raw_dir: str, raw_format: str, multi_line: bool) -> RawTables:
    if raw_format == "csv":
        return read_raw_csv(spark, raw_dir, multi_line=multi_line)
    return read_raw_parquet(spark, raw_dir)


def _staged(
    spark: SparkSession, raw_dir: str, raw_format: str, quarantine: str | None, multi_line: bool
) -> Staged:
    """Raw tables in the shared folder, each read once; rejected CSV rows go to ``quarantine``."""
    if raw_format != "csv" or quarantine is None:
        return stage_raw(_raw(spark, raw_dir, raw_format, multi_line))
    staged = stage_raw_csv(spark, raw_dir, multi_line=multi_line)
    staged.rejects.write.mode("overwrite").parquet(quarantine)
    return staged


def run_etl(
    spark: SparkSession, raw_dir: str, clean_dir: str, rules: Rules = DEFAULT_RULES,
    raw_format: str = "csv", clean_format: str = "parquet", report: bool = True,
    quarantine: str | None = None, multi_line: bool = False,
) -> DataFrame | None:
    """Raw tables to the clean zone; with ``report`` returns the audit, counted while writing.

    For the audit, and with a ``quarantine`` folder for rejected CSV rows, each raw table
    is read once, into the shared folder; otherwise the plans read the raw files.  Without
    a quarantine a row that does not fit the types ends the job.
    """
    if report or quarantine is not None:
        staged = _staged(spark, raw_dir, raw_format, quarantine, multi_line)
        return write_clean_audited(staged, clean_dir, rules, clean_format)
    write_clean(build_clean(_raw(spark, raw_dir, raw_format, multi_line), rules), clean_dir, clean_format)
    return None


def run_load(
    spark: SparkSession, clean_dir: str, warehouse_dir: str, clean_format: str = "parquet",
    enforce: Collection[str] = ENFORCED, multi_line: bool = False,
) -> DataFrame:
    """Clean zone to the warehouse; returns the validation report.

    A star that breaks a constraint named in ``enforce`` is not published.
    """
    star = load_star(read_clean(spark, clean_dir, clean_format, multi_line))
    return publish(star, warehouse_dir, enforce)


def run_build(
    spark: SparkSession, raw_dir: str, warehouse_dir: str, rules: Rules = DEFAULT_RULES,
    raw_format: str = "csv", enforce: Collection[str] = ENFORCED,
    quarantine: str | None = None, multi_line: bool = False,
) -> DataFrame:
    """Raw tables straight to the warehouse; returns the validation report, as ``run_load``."""
    if quarantine is not None:
        raw = _staged(spark, raw_dir, raw_format, quarantine, multi_line).raw
    else:
        raw = _raw(spark, raw_dir, raw_format, multi_line)
    return publish(build_star(raw, rules), warehouse_dir, enforce)


def run_export(
    spark: SparkSession, warehouse_dir: str, payload_dir: str, rules: Rules = DEFAULT_RULES
) -> None:
    """Warehouse to the dashboard payload, one JSON document."""
    star = with_summaries(read_warehouse(spark, warehouse_dir))
    dashboard.write_payload(star, payload_dir, rules)


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="job.py", description=__doc__)
    parser.add_argument("job", choices=("build", "etl", "load", "export"))
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument(
        "--shuffle-partitions", type=int, required=True,
        help="about the input size divided by 256 MB; Spark's own default does not grow",
    )
    parser.add_argument("--raw-format", choices=("csv", "parquet"), default="csv")
    parser.add_argument("--clean-format", choices=("csv", "parquet"), default="parquet")
    parser.add_argument("--rules", help="a JSON file with rules that differ from the defaults")
    parser.add_argument("--report", action="store_true", help="print the audit or the validation")
    parser.add_argument(
        "--quarantine", help="a folder for CSV rows that do not fit; without it they end the job"
    )
    parser.add_argument(
        "--multi-line", action="store_true",
        help="CSV fields may have line breaks; a file is then read by one task",
    )
    parser.add_argument(
        "--publish-broken", action="store_true",
        help="publish a star that breaks declared constraints, and only report them",
    )
    return parser.parse_args(argv)


def main(argv: list[str]) -> None:
    given = arguments(argv)
    rules = Rules.from_json(Path(given.rules).read_text()) if given.rules else DEFAULT_RULES
    spark = session(f"tallymart-{given.job}")
    spark.conf.set("spark.sql.shuffle.partitions", str(given.shuffle_partitions))
    try:
        report = None
        enforce = () if given.publish_broken else ENFORCED
        if given.job == "build":
            report = run_build(
                spark, given.source, given.target, rules, given.raw_format, enforce,
                given.quarantine, given.multi_line,
            )
        elif given.job == "etl":
            report = run_etl(
                spark, given.source, given.target, rules, given.raw_format, given.clean_format,
                given.report, given.quarantine, given.multi_line,
            )
        elif given.job == "load":
            report = run_load(
                spark, given.source, given.target, given.clean_format, enforce, given.multi_line
            )
        else:
            run_export(spark, given.source, given.target, rules)
        if given.report and report is not None:
            report.show(100, truncate=False)
    finally:
        remove_shared(spark)
        spark.stop()
