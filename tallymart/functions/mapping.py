"""Row-level classifications as native expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import Rules

# Status, channel and segment names the results have to carry.
DELIVERED = "delivered"
SUCCESS, FAILED = "Success", "Failed"
CHANNEL_BY_PAYMENT = {"credit_card": "Web", "boleto": "Mobile"}
CHANNEL_OTHER, CHANNEL_MISSING = "Other", "Unknown"
SEGMENTS = ("New", "Returning", "VIP")
UNTRANSLATED, BRAND = "Other", "Generic"


def payment_status_of(order_status: Column) -> Column:
    """Only delivered orders count as paid; null falls to the other side."""
    return F.when(order_status == DELIVERED, SUCCESS).otherwise(FAILED)


def channel_of(payment_type: Column) -> Column:
    steps = [(payment_type == kind, channel) for kind, channel in CHANNEL_BY_PAYMENT.items()]
    return tier([(payment_type.isNull(), CHANNEL_MISSING), *steps], CHANNEL_OTHER)


def segment_of(order_count: Column, rules: Rules) -> Column:
    """Customers without any order are new."""
    new, returning, vip = SEGMENTS
    orders = F.coalesce(order_count, F.lit(0))
    return (
        F.when(orders > rules.segment_returning_max, vip)
        .when(orders > rules.segment_new_max, returning)
        .otherwise(new)
    )


def tier(steps: Sequence[tuple[Column, str]], default: str) -> Column:
    """First label whose condition holds, else ``default``."""
    labelled = F.when(*steps[0])
    for condition, label in steps[1:]:
        labelled = labelled.when(condition, label)
    return labelled.otherwise(default)
