"""Business rules: one immutable value handed to every plan."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields
from decimal import Decimal


@dataclass(frozen=True)
class Rules:
    # Defaults a user of the engine expects.
    currency_rate: Decimal = Decimal("0.20")
    cost_ratio: Decimal = Decimal("0.6")
    segment_new_max: int = 1
    segment_returning_max: int = 5
    low_margin: Decimal = Decimal("0.10")
    failed_payment: Decimal = Decimal("0.05")
    one_time_pct: Decimal = Decimal("70")
    review_margin_pct: Decimal = Decimal("15")
    review_revenue_rank: float = 0.2
    review_limit: int = 5
    min_product_revenue: Decimal = Decimal("100")
    product_limit: int = 20
    category_limit: int = 10
    category_api_limit: int = 15
    customer_limit: int = 10

    @classmethod
    def from_json(cls, text: str) -> Rules:
        """The defaults with the values of a JSON object in their place; unknown names are errors."""
        given = json.loads(text, parse_float=Decimal)
        kinds = {f.name: type(f.default) for f in fields(cls)}
        unknown = sorted(set(given) - set(kinds))
        if unknown:
            raise ValueError(f"no such rules: {', '.join(unknown)}")
        return cls(**{name: kinds[name](value) for name, value in given.items()})

    @property
    def low_margin_pct(self) -> Decimal:
        return self.low_margin * 100

    @property
    def failed_payment_pct(self) -> Decimal:
        return self.failed_payment * 100


DEFAULT_RULES = Rules()
