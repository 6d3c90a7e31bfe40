"""Writing the clean zone and the warehouse with their checks on the way."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..rules import DEFAULT_RULES, Rules
from ..sources.raw import RawTables, Staged
from ..sources.star import (
    Star,
    drop_version,
    publish_version,
    read_version,
    write_clean,
    write_version,
)
from .quality import counter_columns, key_report, report_rows
from .star import build_clean, build_fact

#: Checks that a version has to pass.  The fact's grain is the order item, so an order may
#: have a product twice, and that is only reported.
ENFORCED = ("nulls", "domain", "orphans", "duplicates")
REPORTED_ONLY = (("duplicates", "fact_orders"),)


class ConstraintError(ValueError):
    """A version that breaks declared constraints; ``broken`` has (check, table, subject, rows)."""

    def __init__(self, broken: list[tuple[str, str, str, int]]):
        self.broken = broken
        super().__init__("; ".join(f"{check} {table}.{subject}: {n}" for check, table, subject, n in broken))


def _counted(df: DataFrame, name: str, counters: dict) -> tuple[DataFrame, Observation]:
    seen = Observation(name)
    return df.observe(seen, *(value.alias(key) for key, value in counters.items())), seen


def publish(
    star: Star, directory: str, enforce: Collection[str] = ENFORCED, keep: int = 2
) -> DataFrame:
    """Write a new version and let readers see it only if it meets the declared constraints.

    Rows, nulls and domains are counted while the tables are written; keys are checked on
    the written version.  On a violation the version is removed, CURRENT stays as it is, and
    ConstraintError says what is broken.  Returns the validation report.
    """
    spark = star.fact_orders.sparkSession
    tables, observed = {}, {}
    for name, df in star.tables().items():
        tables[name], observed[name] = _counted(df, f"checks-{name}", counter_columns(name))
    version = write_version(star._replace(**tables), directory)
    verdicts = {key: n for seen in observed.values() for key, n in seen.get.items()}
    counts = spark.createDataFrame([tuple(verdicts.values())], [f"{key}" for key in verdicts])
    # A report has a few dozen rows.
    rows = report_rows(counts).unionByName(key_report(read_version(spark, directory, version))).collect()
    broken = [
        (r.check_name, r.table_name, r.subject, r.n)
        for r in rows
        if r.n and r.check_name in enforce and (r.check_name, r.table_name) not in REPORTED_ONLY
    ]
    if broken:
        drop_version(spark, directory, version)
        raise ConstraintError(sorted(broken))
    publish_version(spark, directory, version, keep)
    return spark.createDataFrame(rows, "check_name string, table_name string, subject string, n long")


def write_clean_audited(
    staged: Staged, directory: str, rules: Rules = DEFAULT_RULES, fmt: str = "parquet"
) -> DataFrame:
    """Write the clean zone from staged raw tables; returns the audit, counted while writing.

    The rows are those of ``quality.etl_audit``, and with rejects one row per table that has some.
    """
    raw: RawTables = staged.raw
    fact_seen = Observation("audit-fact")
    clean = build_clean(raw, rules)._replace(fact_orders=build_fact(raw, rules, fact_seen))
    tables, observed = {}, {}
    for name in ("dim_customer", "dim_product", "dim_date"):
        counters = {name: F.count(F.lit(1))}
        tables[name], observed[name] = _counted(getattr(clean, name), f"audit-{name}", counters)
    write_clean(clean._replace(**tables), directory, fmt)
    found = {f"read_{name}": n for name, n in staged.read.items()} | fact_seen.get
    found["items_repeated"] = staged.read["order_items"] - found["items_unique"]
    for seen in observed.values():
        found |= seen.get
    found |= {f"rejected_{name}": n for name, n in staged.rejected.items() if n}
    spark: SparkSession = raw.orders.sparkSession
    return spark.createDataFrame(list(found.items()), "stage string, n_rows long")
