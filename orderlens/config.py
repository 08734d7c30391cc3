"""Parameters of the pipeline, in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal

# Category spellings that are put right after cleaning.
CATEGORY_CORRECTIONS = {
    "Sqalads": "Salads",
    "Sandwiches": "Sandwiches",
}


@dataclass(frozen=True)
class Config:
    # Orders whose app_name equals this value are test orders; it differs from source to source.
    test_app_name: str
    category_corrections: dict[str, str] = field(
        default_factory=lambda: dict(CATEGORY_CORRECTIONS)
    )

    calendar_start: date = date(2020, 1, 1)
    calendar_end: date = date(2024, 12, 31)

    bulk_price: Decimal = Decimal("5000")
    bulk_quantity: int = 100

    # The day every look-back counts from; None means the newest order day.
    reference_day: date | None = None
    churn_days: int = 45
    rfm_months: int = 6
    spend_window_days: int = 90

    clv_high_share: float = 0.80
    clv_medium_share: float = 0.20
    # "snapshots" weighs every customer by its snapshot rows, "customers" counts each once.
    clv_population: str = "snapshots"

    top_locations: int = 5
    bottom_locations: int = 3

    def __post_init__(self) -> None:
        if self.clv_population not in ("snapshots", "customers"):
            raise ValueError("clv_population must be 'snapshots' or 'customers'")
        if self.calendar_end < self.calendar_start:
            raise ValueError("calendar_end lies before calendar_start")
