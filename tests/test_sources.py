from __future__ import annotations

import json
from decimal import Decimal

from tallymart import jobs
from tallymart.plans import kpi
from tallymart.plans import star as etl
from tallymart.plans.load import load_star
from tallymart.sources.raw import RAW_FILES, read_raw_csv, register_raw
from tallymart.sources.star import (
    read_clean,
    read_warehouse,
    register_views,
    write_clean,
    write_warehouse,
)

from build import item, order, raw_tables, values

CSV = {
    # More columns than needed, in another order than the schemas list them.
    "orders": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at
o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15
o2,c2,shipped,2018-07-24 20:41:37,
""",
    "order_items": """order_id,order_item_id,product_id,seller_id,price,freight_value
o1,1,p1,s1,58.90,13.29
o1,2,p2,s1,19.99,1.00
o2,1,p1,s1,239.90,19.93
""",
    "customers": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,14409,franca,SP
c2,u2,09790,sao bernardo do campo,SP
""",
    "products": """product_id,product_category_name,product_photos_qty
p1,perfumaria,1
p2,,1
""",
    "payments": """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,credit_card,8,92.18
o2,1,boleto,1,259.83
""",
    "category_translation": """product_category_name,product_category_name_english
perfumaria,perfumery
""",
}


def _raw_files(directory):
    for name, file in RAW_FILES.items():
        (directory / file).write_text(CSV[name])
    return str(directory)


def test_raw_csv_by_name(spark, tmp_path):
    raw = read_raw_csv(spark, _raw_files(tmp_path))
    assert sorted(values(raw.order_items, "order_id", "order_item_id", "product_id", "price")) == [
        ("o1", 1, "p1", Decimal("58.90")), ("o1", 2, "p2", Decimal("19.99")),
        ("o2", 1, "p1", Decimal("239.90")),
    ]
    register_raw(raw)
    assert spark.sql("SELECT count(*) FROM raw_customers").first()[0] == 2


def test_jobs_from_raw_files_to_payload(spark, tmp_path):
    raw_dir = tmp_path / "raw"
    raw_dir.mkdir()
    clean, warehouse, out = (str(tmp_path / d) for d in ("clean", "warehouse", "payload"))
    audit = jobs.run_etl(spark, _raw_files(raw_dir), clean)
    assert dict(values(audit, "stage", "n_rows"))["fact_orders"] == 3
    report = jobs.run_load(spark, clean, warehouse)
    assert {r.n for r in report.collect() if r.check_name not in ("row_count",)} == {0}
    direct = str(tmp_path / "direct")
    assert sorted(jobs.run_build(spark, str(raw_dir), direct).collect()) == sorted(report.collect())
    for name, df in read_warehouse(spark, direct).tables().items():
        assert df.exceptAll(read_warehouse(spark, warehouse).tables()[name]).count() == 0
    jobs.run_export(spark, warehouse, out)
    data = json.loads(spark.read.text(out).first().value)
    assert data["kpis"] == {
        "total_revenue": 15.78, "total_profit": 6.31, "profit_margin": 39.99,
        "order_success_rate": 66.67, "total_orders": 3, "successful_orders": 2,
    }
    assert data["channels"]["channel"] == ["Web", "Mobile"]
    assert data["categories"]["category"] == ["perfumery", "Other"]


def test_clean_zone_keeps_types_in_both_formats(spark, tmp_path):
    raw = raw_tables(spark, orders=[order("o1")], order_items=[item("o1")],
                     customers=[("c1", "u", "town", "SP")], products=[("p1", None)])
    clean = etl.build_clean(raw)
    for fmt in ("csv", "parquet"):
        write_clean(clean, str(tmp_path / fmt), fmt)
        back = read_clean(spark, str(tmp_path / fmt), fmt)
        for name, df in clean.tables().items():
            again = back.tables()[name]
            assert again.dtypes == df.dtypes, (fmt, name)
            assert again.collect() == df.collect(), (fmt, name)


def test_warehouse_replaces_and_partitions_by_month(spark, tmp_path):
    def load(*days):
        raw = raw_tables(
            spark,
            orders=[order(f"o{d}", placed=f"{d} 00:00:00") for d in days],
            order_items=[item(f"o{d}") for d in days],
            customers=[("c1", "u", "town", "SP")], products=[("p1", None)],
        )
        write_warehouse(load_star(etl.build_clean(raw)), str(tmp_path))
        return read_warehouse(spark, str(tmp_path))

    load("2020-01-01", "2020-02-01")
    star = load("2020-02-01", "2020-03-01", "2020-03-02")
    version = (tmp_path / "CURRENT").read_text().strip()
    months = sorted(p.name for p in (tmp_path / version / "fact_orders").glob("order_month=*"))
    assert months == ["order_month=202002", "order_month=202003"]
    register_views(star)
    assert spark.sql("SELECT count(*) FROM fact_orders").first()[0] == 3
    assert values(kpi.monthly_trend(star), "year", "month", "order_count") == [(2020, 2, 1), (2020, 3, 2)]
