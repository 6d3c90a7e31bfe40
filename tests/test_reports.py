from __future__ import annotations

import json
from decimal import Decimal

import pytest

from tallymart.plans import dashboard, insights, kpi, quality, questions
from tallymart.plans.totals import with_summaries
from tallymart.rules import Rules

from build import mapping, sale, star_of, values


def _margins(spark, margins):
    """One category per margin percentage, revenue 200 each."""
    return star_of(
        spark,
        [
            sale(f"o{m}", product=m, revenue="200.00", profit=str(Decimal(2 * m)))
            for m in margins
        ],
    )


def _failures(spark, rates):
    """One channel per failure percentage, 100 items each."""
    return star_of(
        spark,
        [
            sale(f"{r}-{i}", channel=f"ch{r:02d}", status="Failed" if i < r else "Success")
            for r in rates
            for i in range(100)
        ],
    )


def test_margin_tiers_are_strict(spark):
    star = _margins(spark, [9, 10, 19, 20])
    assert mapping(questions.product_margin(star), "product_id", "margin_status") == {
        "p9": "LOW MARGIN", "p10": "MEDIUM MARGIN", "p19": "MEDIUM MARGIN", "p20": "HEALTHY MARGIN",
    }


def test_product_margin_needs_revenue_over_the_minimum(spark):
    star = star_of(spark, [sale("o1", revenue="100.00"), sale("o2", product=2, revenue="100.01")])
    assert values(questions.product_margin(star), "product_id") == [("p2",)]


def test_margin_tier_tests_the_unrounded_margin(spark):
    star = star_of(spark, [sale("o1", revenue="100000.00", profit="9999.90")])
    assert values(questions.product_margin(star), "profit_margin_pct", "margin_status") == [
        (Decimal("10.00"), "LOW MARGIN")
    ]


def test_low_margin_insights(spark):
    star = _margins(spark, [4, 5, 10])
    got = values(insights.low_margin(star), "title", "severity")
    assert got == [("Low Margin Alert: cat4", "high"), ("Low Margin Alert: cat5", "medium")]


def test_low_margin_message_and_order(spark):
    star = star_of(
        spark,
        [
            sale("o1", product=1, revenue="1234.50", profit="61.73"),
            sale("o2", product=2, revenue="9876543.21", profit="-100.00"),
        ],
    )
    assert values(insights.low_margin(star), "rank", "message") == [
        (1, "Category 'cat2' has 0.0% margin (below 10.0% threshold) with $9,876,543 revenue"),
        (2, "Category 'cat1' has 5.0% margin (below 10.0% threshold) with $1,234 revenue"),
    ]


def test_failure_tiers_and_alerts_are_strict(spark):
    star = _failures(spark, [2, 3, 5, 6, 10, 11])
    assert mapping(questions.channel_failure(star), "channel", "failure_status") == {
        "ch02": "LOW FAILURE", "ch03": "MODERATE FAILURE", "ch05": "MODERATE FAILURE",
        "ch06": "HIGH FAILURE", "ch10": "HIGH FAILURE", "ch11": "HIGH FAILURE",
    }
    assert values(insights.failed_payments(star), "title", "severity") == [
        ("High Failure Rate: ch11 Channel", "high"),
        ("High Failure Rate: ch10 Channel", "medium"),
        ("High Failure Rate: ch06 Channel", "medium"),
    ]
    channels = kpi.channel_performance(star)
    assert mapping(dashboard.channel_tiers(channels), "channel", "tier") == {
        "ch02": "ok", "ch03": "ok", "ch05": "ok", "ch06": "warning", "ch10": "warning",
        "ch11": "danger",
    }
    assert sorted(values(dashboard.operational_alerts(channels), "channel")) == [
        ("ch06",), ("ch10",), ("ch11",),
    ]


def _churn_star(spark):
    """Ten buyers per segment: 5 of New and 7 of VIP buy once, the others twice."""
    sales, customers = [], {}
    for segment, once, base in (("New", 5, 0), ("VIP", 7, 10)):
        for i in range(10):
            key = base + i
            customers[key] = segment
            for n in range(1 if i < once else 2):
                sales.append(sale(f"{key}-{n}", customer=key, day=f"2020-01-{10 + 10 * n}"))
    return star_of(spark, sales, customers=customers)


def test_churn_tiers_are_strict(spark):
    got = values(
        questions.segment_churn(_churn_star(spark)), "segment", "churn_rate_pct", "churn_status",
        "avg_orders_per_customer", "avg_days_active",
    )
    assert got == [
        ("VIP", Decimal("70.00"), "MODERATE CHURN", Decimal("1.30"), Decimal("3")),
        ("New", Decimal("50.00"), "LOW CHURN", Decimal("1.50"), Decimal("5")),
    ]


def test_retention_insight_is_strict_and_counts_all_customers(spark):
    star = _churn_star(spark)
    assert insights.customer_retention(star).count() == 0
    got = values(insights.customer_retention(star, Rules(one_time_pct=Decimal(69))), "message")
    assert got == [("70.0% of VIP customers (7) made only one purchase",)]


def test_customers_without_paid_order(spark):
    star = star_of(
        spark,
        [sale("o1", customer=1), sale("o1", customer=1, product=2), sale("o2", customer=2, status="Failed")],
        customers={1: "New", 2: "New", 3: "New"},
    )
    assert values(
        kpi.customer_segments(star), "customer_count", "order_count", "avg_order_value"
    ) == [(3, 1, Decimal("100.00"))]
    assert values(kpi.revenue_per_customer(star), "customer_count", "revenue_per_customer") == [
        (1, Decimal("200.00"))
    ]
    assert values(questions.segment_churn(star), "customer_count", "churn_rate_pct") == [
        (1, Decimal("100.00"))
    ]
    assert insights.customer_retention(star).count() == 0


def test_retention_over_new_year(spark):
    star = star_of(spark, [sale("o1", day="2019-12-05"), sale("o2", day="2020-01-05"), sale("o3", day="2020-02-05")])
    assert values(kpi.retention(star), "month", "retained_customers") == [(12, 0), (1, 0), (2, 1)]
    crossing = kpi.retention(star, cross_year=True)
    assert values(crossing, "month", "retained_customers") == [(12, 0), (1, 1), (2, 1)]


def test_recommendations(spark):
    # Revenue falls with the product number, so ranks are 0, .25, .5, .75 and 1.
    margins = {1: "14.99", 2: "15.00", 3: "50.00", 4: "9.00", 5: "40.00"}
    star = star_of(
        spark,
        [
            sale(f"o{p}", product=p, revenue=f"{600 - 100 * p}.00",
                 profit=str(Decimal(m) * (6 - p)))
            for p, m in margins.items()
        ],
    )
    assert values(questions.category_recommendation(star), "category", "recommendation") == [
        ("cat4", "DISCONTINUE - Low margin, low revenue"),
        ("cat1", "REVIEW - Low margin"),
        ("cat5", "REVIEW - Low revenue"),
        ("cat2", "KEEP"),
        ("cat3", "KEEP"),
    ]


def test_category_review_lists_lowest_revenue_first(spark):
    star = star_of(
        spark,
        [sale(f"o{p}", product=p, revenue=f"{100 * p}.00", profit="1.00") for p in range(1, 31)],
    )
    got = values(insights.category_review(star), "message", "severity")
    names = "cat1, cat2, cat3, cat4, cat5"
    assert got == [
        (f"Consider reviewing these low-revenue, low-margin categories: {names}", "low")
    ]
    assert insights.category_review(_margins(spark, [30, 40])).count() == 0


def test_category_mix_counts_an_order_in_each_category(spark):
    star = star_of(spark, [sale("o1", product=1), sale("o1", product=2), sale("o2", product=1)])
    assert values(
        questions.category_mix(star), "category", "product_count", "order_count",
        "order_share_pct", "revenue_share_pct",
    ) == [
        ("cat1", 1, 2, Decimal("100.00"), Decimal("66.67")),
        ("cat2", 1, 1, Decimal("50.00"), Decimal("33.33")),
    ]


def test_top_customers_ties_and_limit(spark):
    star = star_of(
        spark,
        [sale(f"o{c}-{n}", customer=c) for c in range(1, 13) for n in range(2)]
        + [sale("x", customer=12, revenue="0.01")],
    )
    got = values(kpi.top_customers(star, 3), "customer_id", "order_count", "total_revenue")
    assert got == [
        ("id12", 3, Decimal("200.01")), ("id1", 2, Decimal("200.00")),
        ("id10", 2, Decimal("200.00")),
    ]
    ranked = dashboard.customer_rank(kpi.top_customers(star, 3))
    assert values(ranked, "position", "short_id") == [(1, "id12…"), (2, "id1…"), (3, "id10…")]


def test_empty_warehouse(spark):
    star = star_of(spark, [], customers={}, products={})
    assert insights.generate(star).count() == 0
    assert values(insights.summary(insights.generate(star)), "total", "high", "medium", "low") == [
        (0, 0, 0, 0)
    ]
    assert values(kpi.executive(star), "total_orders", "successful_orders", "profit_margin",
                  "order_success_rate", "total_revenue") == [(0, 0, None, None, None)]
    assert kpi.monthly_trend(star).count() == 0
    assert values(kpi.order_value(star), "avg_order_value") == [(None,)]
    payload = json.loads(dashboard.payload_json(star).first().value)
    assert payload["insights"] == [] and payload["trends"]["year_month"] == []


@pytest.fixture(scope="module")
def graded(spark, sf_dir):
    from checks import stars

    return stars.star(spark, sf_dir, "graded")


REPORTS = [
    kpi.revenue, kpi.success_rate, kpi.executive, kpi.failed_by_channel, kpi.revenue_per_customer,
    kpi.revenue_by_category, kpi.monthly_trends, kpi.channel_by_month, kpi.customer_segments,
    kpi.channel_performance, kpi.top_customers, questions.product_margin, questions.top_customers,
    questions.channel_failure, questions.category_mix, insights.generate,
]


@pytest.fixture(scope="module")
def summed(graded):
    return with_summaries(graded)


@pytest.mark.parametrize("report", REPORTS, ids=lambda r: f"{r.__module__}.{r.__name__}")
def test_summaries_give_the_same_reports(graded, summed, report):
    assert report(summed).collect() == report(graded).collect()


def test_payload_shape_and_invariants(spark, graded):
    data = json.loads(dashboard.payload_json(graded).first().value)
    assert list(data) == [
        "kpis", "trends", "categories", "segments", "top_customers", "channels", "insights",
    ]
    assert list(data["trends"]) == ["year_month", "revenue", "profit", "orders"]
    assert list(data["categories"]) == ["category", "revenue", "profit", "margin", "orders"]
    assert list(data["segments"]) == [
        "segment", "customer_count", "order_count", "revenue", "avg_order_value",
    ]
    assert list(data["channels"]) == [
        "channel", "total_orders", "successful_orders", "revenue", "failure_rate",
    ]
    assert list(data["top_customers"][0]) == [
        "customer_id", "segment", "country", "order_count", "total_revenue", "avg_order_value",
    ]
    assert list(data["insights"][0]) == ["type", "category", "title", "message", "severity"]
    total = data["kpis"]["total_revenue"]
    assert sum(data["trends"]["revenue"]) == pytest.approx(total)
    assert sum(data["channels"]["revenue"]) == pytest.approx(total)
    assert sum(data["segments"]["revenue"]) == pytest.approx(total)
    assert sum(data["trends"]["profit"]) == pytest.approx(data["kpis"]["total_profit"])
    assert sum(data["trends"]["orders"]) == sum(data["segments"]["order_count"])
    assert sum(data["channels"]["total_orders"]) == data["kpis"]["total_orders"]
    assert sum(data["channels"]["successful_orders"]) == data["kpis"]["successful_orders"]
    assert data["trends"]["year_month"] == sorted(data["trends"]["year_month"])


def test_validation_finds_broken_rows(spark):
    star = star_of(
        spark,
        [sale("o1"), sale("o1"), sale("o2", status="Pending")],
        customers={7: "Gold"}, products={1: "cat1"},
    )
    report = {
        (r.check_name, r.table_name, r.subject): r.n
        for r in quality.validation_report(star).collect()
    }
    assert report["orphans", "dim_customer", "customer_key"] == 3
    assert report["orphans", "dim_product", "product_key"] == 0
    assert report["duplicates", "fact_orders", "order_id, product_key"] == 1
    assert report["domain", "fact_orders", "payment_status"] == 1
    assert report["domain", "dim_customer", "segment"] == 1
    assert report["row_count", "fact_orders", "*"] == 3
    assert report["nulls", "fact_orders", "revenue"] == 0
