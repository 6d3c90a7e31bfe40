"""CSV as other programs write it, rows that do not fit, and the audit of the write."""

from __future__ import annotations

import shutil
from decimal import Decimal

import pytest
from build import item, order, raw_tables, sale, star_of, values
from pyspark.sql import functions as F
from test_sources import CSV, _raw_files

from tallymart import jobs
from tallymart.plans import quality
from tallymart.plans import star as etl
from tallymart.plans.publish import ConstraintError, publish, write_clean_audited
from tallymart.sources.raw import RAW_FILES, read_raw_csv, reject_counts, stage_raw, stage_raw_csv
from tallymart.sources.star import read_clean, read_warehouse, write_clean

# By hand: doubled quotes, commas and line breaks inside fields, rows that do not fit.
CUSTOMERS = '''customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state
c1,u1,14409,"a ""q"", b",SP
c2,u2,09790,"C:\\dir\\",SP
c3,u3,1,"two
lines",RJ
c4,u4,2,short
c5,u5,3,long,SP,more
"c""6",u6,4,,
'''
ITEMS = """order_id,order_item_id,product_id,seller_id,price,freight_value
o1,1,p1,s1,58.90,13.29
o1,2,p2,s1,19.99,1.00
o2,1,p1,s1,free,19.93
o2,x,p1,s1,1.00,19.93
o2,3,p1
o3,1,,s1,,
"""


def _files(directory, **other) -> str:
    _raw_files(directory)
    for name, text in other.items():
        (directory / RAW_FILES[name]).write_text(text)
    return str(directory)


def test_quotes_and_line_breaks(spark, tmp_path):
    good = "".join(line for line in CUSTOMERS.splitlines(True) if line[:2] not in ("c4", "c5"))
    raw = read_raw_csv(spark, _files(tmp_path, customers=good), multi_line=True)
    assert sorted(values(raw.customers, "customer_id", "customer_city", "customer_state")) == [
        ('c"6', None, None), ("c1", 'a "q", b', "SP"), ("c2", "C:\\dir\\", "SP"), ("c3", "two\nlines", "RJ"),
    ]


def test_rows_that_do_not_fit_are_set_aside(spark, tmp_path):
    staged = stage_raw_csv(spark, _files(tmp_path, customers=CUSTOMERS, order_items=ITEMS), multi_line=True)
    assert sorted(values(staged.raw.customers, "customer_id", "customer_city")) == [
        ('c"6', None), ("c1", 'a "q", b'), ("c2", "C:\\dir\\"), ("c3", "two\nlines"),
    ]
    assert sorted(values(staged.raw.order_items, "order_id", "order_item_id", "price")) == [
        ("o1", 1, Decimal("58.90")), ("o1", 2, Decimal("19.99")), ("o3", 1, None),
    ]
    rejects = {(r.table_name, r.reason, r.record) for r in staged.rejects.collect()}
    assert rejects == {
        ("customers", "number of fields", "c4,u4,2,short"),
        ("customers", "number of fields", "c5,u5,3,long,SP,more"),
        ("order_items", "price is no decimal(18,2)", "o2,1,p1,s1,free,19.93"),
        ("order_items", "order_item_id is no int", "o2,x,p1,s1,1.00,19.93"),
        ("order_items", "number of fields", "o2,3,p1"),
    }
    assert {r.file.rsplit("/")[-1] for r in staged.rejects.collect()} == {RAW_FILES["customers"], RAW_FILES["order_items"]}
    assert staged.read | {"customers": 4, "order_items": 3} == staged.read
    assert staged.rejected == dict.fromkeys(RAW_FILES, 0) | {"customers": 2, "order_items": 3}
    counts = {(r.table_name, r.reason): r.n_rows for r in reject_counts(staged.rejects).collect()}
    assert counts["customers", "number of fields"] == 2 and sum(counts.values()) == 5


def test_empty_files_and_no_rejects(spark, tmp_path):
    heads = {name: text.splitlines(True)[0] for name, text in CSV.items()}
    staged = stage_raw_csv(spark, _files(tmp_path, **heads))
    assert all(df.count() == 0 for df in staged.raw) and staged.rejects.count() == 0
    assert [df.schema for df in staged.raw] == [df.schema for df in read_raw_csv(spark, str(tmp_path))]


def test_etl_reads_each_raw_table_once(spark, tmp_path):
    """Once staged, the raw files may go: audit and clean zone come from what was read."""
    (tmp_path / "raw").mkdir()
    folder = _files(tmp_path / "raw", order_items=ITEMS)
    staged = stage_raw_csv(spark, folder)
    want = quality.etl_audit(staged.raw)
    kept = etl.build_fact(staged.raw).collect()
    shutil.rmtree(folder)
    audit = dict(values(write_clean_audited(staged, str(tmp_path / "clean")), "stage", "n_rows"))
    assert audit == dict(values(want, "stage", "n_rows")) | {"rejected_order_items": 3}
    assert read_clean(spark, str(tmp_path / "clean")).fact_orders.exceptAll(etl.build_fact(staged.raw)).count() == 0 and len(kept) == 2


@pytest.mark.parametrize("name", ["plain", "graded", "copied"])
def test_audit_of_the_write_is_the_audit(spark, sf_dir, tmp_path, name):
    from checks import stars

    raw = stars.raw(spark, sf_dir, name)
    found = write_clean_audited(stage_raw(raw), str(tmp_path))
    assert sorted(found.collect()) == sorted(quality.etl_audit(raw).collect())


def test_quarantine_job(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    folder = _files(tmp_path / "raw", order_items=ITEMS, customers=CUSTOMERS)
    clean, bad = str(tmp_path / "clean"), str(tmp_path / "bad")
    audit = jobs.run_etl(spark, folder, clean, quarantine=bad, multi_line=True)
    assert dict(values(audit, "stage", "n_rows"))["rejected_customers"] == 2
    assert spark.read.parquet(bad).count() == 5
    jobs.run_build(spark, folder, str(tmp_path / "wh"), quarantine=bad, multi_line=True)
    assert read_warehouse(spark, str(tmp_path / "wh")).fact_orders.count() == 2
    with pytest.raises(Exception, match="free|CAST_INVALID_INPUT|malformed"):
        jobs.run_etl(spark, folder, clean, report=False, multi_line=True)


def test_clean_csv_with_quotes_is_read_by_others(spark, tmp_path):
    raw = raw_tables(
        spark, orders=[order("o1")], order_items=[item("o1")], products=[("p1", None)],
        customers=[("c1", "u", "town", 'S "P", or\\ so')],
    )
    write_clean(etl.build_clean(raw), str(tmp_path), "csv")
    (part,) = (tmp_path / "dim_customer").glob("part-*.csv")
    import pandas as pd

    assert pd.read_csv(part).country.tolist() == ['S "P", or\\ so']
    assert read_clean(spark, str(tmp_path), "csv").dim_customer.first().country == 'S "P", or\\ so'


def test_a_broken_build_is_not_published(spark, tmp_path):
    folder = str(tmp_path)
    good = star_of(spark, [sale("o1"), sale("o2", product=2, customer=3)])
    report = publish(good, folder)
    assert sorted(report.collect()) == sorted(quality.validation_report(read_warehouse(spark, folder)).collect())
    current = (tmp_path / "CURRENT").read_text()
    fact, customers = good.fact_orders, good.dim_customer
    broken = {
        ("nulls", "fact_orders", "revenue"): good._replace(fact_orders=fact.withColumn("revenue", F.when(F.col("order_id") == "o1", F.col("revenue")))),
        ("domain", "fact_orders", "payment_status"): good._replace(fact_orders=fact.withColumn("payment_status", F.lit("Refunded"))),
        ("orphans", "dim_product", "product_key"): good._replace(dim_product=good.dim_product.where("product_key = 1")),
        ("duplicates", "dim_customer", "customer_key"): good._replace(dim_customer=customers.unionByName(customers.withColumn("customer_id", F.concat("customer_id", F.lit("x"))))),
    }
    for which, star in broken.items():
        with pytest.raises(ConstraintError) as error:
            publish(star, folder)
        assert [b[:3] for b in error.value.broken] == [which] and error.value.broken[0][3] > 0
        assert (tmp_path / "CURRENT").read_text() == current
        assert len(list(tmp_path.glob("version-*"))) == 1
        assert read_warehouse(spark, folder).fact_orders.count() == 2
    twice = star_of(spark, [sale("o1"), sale("o1")])
    report = {(r.check_name, r.table_name): r.n for r in publish(twice, folder).collect()}
    assert report["duplicates", "fact_orders"] == 1  # reported, but allowed
    publish(broken["domain", "fact_orders", "payment_status"], folder, enforce=())
    assert read_warehouse(spark, folder).fact_orders.first().payment_status == "Refunded"
