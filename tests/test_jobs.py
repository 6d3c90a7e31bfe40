"""The job script in processes of its own, the versioned warehouse and the shared folder."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from build import raw_tables, order, item, sale, star_of
from pyspark.sql import functions as F
from test_sources import _raw_files

from tallymart.plans import kpi, quality, questions
from tallymart.plans import star as etl
from tallymart.plans.load import load_star
from tallymart.rules import Rules
from tallymart.sources import shared
from tallymart.sources.star import read_warehouse, write_warehouse

REPO = Path(__file__).resolve().parent.parent


def run(folder: Path, *args: str) -> str:
    conf = (
        f"--master local[2] --conf spark.ui.enabled=false"
        f" --conf spark.checkpoint.dir={folder / 'shared'} pyspark-shell"
    )
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": conf}
    env.pop("PYTHONPATH", None)
    done = subprocess.run(
        [sys.executable, str(REPO / "job.py"), *args, "--shuffle-partitions", "2"],
        cwd=folder, env=env, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


def test_jobs_as_processes(tmp_path):
    raw_dir = tmp_path / "raw"
    raw_dir.mkdir()
    _raw_files(raw_dir)
    clean, direct, warehouse, out = (str(tmp_path / d) for d in ("clean", "direct", "wh", "out"))
    assert "row_count" in run(tmp_path, "build", str(raw_dir), direct, "--report")
    run(tmp_path, "etl", str(raw_dir), clean, "--clean-format", "csv")
    run(tmp_path, "load", clean, warehouse, "--clean-format", "csv")
    rules = tmp_path / "rules.json"
    rules.write_text('{"customer_limit": 1}')
    run(tmp_path, "export", warehouse, out, "--rules", str(rules))
    (part,) = Path(out).glob("part-*")
    data = json.loads(part.read_text())
    assert data["kpis"]["total_revenue"] == 15.78 and len(data["top_customers"]) == 1
    left = [p for p in (tmp_path / "shared").rglob("*") if p.is_file()]
    assert left == []  # intermediate tables go with the job


def test_rules_from_json():
    rules = Rules.from_json('{"currency_rate": 0.25, "product_limit": 3}')
    assert rules == Rules(currency_rate=Decimal("0.25"), product_limit=3)
    with pytest.raises(ValueError):
        Rules.from_json('{"currency": 1}')


def test_a_failed_load_leaves_the_old_star(spark, tmp_path):
    def raw(*days):
        return raw_tables(
            spark, orders=[order(f"o{d}", placed=f"{d} 00:00:00") for d in days],
            order_items=[item(f"o{d}") for d in days],
            customers=[("c1", "u", "town", "SP")], products=[("p1", None)],
        )

    folder = str(tmp_path)
    write_warehouse(load_star(etl.build_clean(raw("2020-01-01"))), folder)
    star = load_star(etl.build_clean(raw("2020-02-01", "2020-02-02")))
    failing = star._replace(
        fact_orders=star.fact_orders.withColumn(
            "order_id", F.when(F.col("quantity") == 1, F.raise_error(F.lit("lost"))).otherwise("order_id")
        )
    )
    with pytest.raises(Exception, match="lost"):
        write_warehouse(failing, folder)
    old = read_warehouse(spark, folder)
    assert [r.order_id for r in old.fact_orders.collect()] == ["o2020-01-01"]
    for _ in range(3):
        write_warehouse(star, folder)
    assert read_warehouse(spark, folder).fact_orders.count() == 2
    assert old.dim_date.columns and len(list(tmp_path.glob("version-*"))) == 2


class _Session:
    """Just the settings of a session."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = {k.replace("__", "."): v for k, v in settings.items()}

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_shared_folder_fails_closed():
    for master in ({}, {"spark__master": "yarn"}, {"spark__master": "local-cluster[2,1,512]"}):
        with pytest.raises(RuntimeError):
            shared.shared_dir(_Session(**master), "x")
    named = _Session(spark__checkpoint__dir="hdfs://x/y/", spark__app__id="a")
    assert shared.shared_dir(named, "x").startswith("hdfs://x/y/tallymart/a/x-")


def test_null_copies_never_win(spark):
    raw = raw_tables(
        spark, orders=[order("o1"), order("o2", placed=None), order("o2")],
        order_items=[item("o1"), item("o1", product=None), item("o2")],
        customers=[("c1", "u", "town", None), ("c1", "u", "town", "SP")],
        products=[("p1", None), ("p1", "x")],
    )
    assert etl.build_fact(raw).count() == 2
    assert [r.country for r in etl.build_dim_customer(raw).collect()] == ["SP"]


def test_mixed_orders_are_reported(spark):
    star = star_of(spark, [sale("o1"), sale("o1", customer=2, product=2), sale("o2")])
    report = {r.check_name: r.n for r in quality.validation_report(star).collect() if r.check_name == "mixed_orders"}
    assert report == {"mixed_orders": 1}


def scans(df) -> int:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    fact = ("order_id#", "payment_status#")  # columns that only the fact has
    return sum("FileScan" in line and any(c in line for c in fact) for line in plan.splitlines())


def test_fact_scans(spark, sf_dir):
    from checks import stars

    star = stars.star(spark, sf_dir, "graded")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert scans(quality.validation_report(star)) == 2
        assert scans(questions.category_mix(star)) == 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_long_list_of_customers_is_not_broadcast_by_hint(spark, sf_dir):
    from checks import stars

    star = stars.star(spark, sf_dir, "graded")
    report = kpi.top_customers(star, 100_000)
    small = kpi.top_customers(star, 10).collect()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = kpi.top_customers(star, 100_000)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert kpi.top_customers(star, 100_000).collect()[:10] == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert report.count() > 10
