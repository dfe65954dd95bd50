"""Parameters of the analysis queries; the defaults belong to the marketplace data, BENCHMARK to the parquet tables."""

from __future__ import annotations

from dataclasses import dataclass

# Categories people buy again and again.
CONSUMABLES = ("health_beauty", "perfumery", "food", "drinks", "food_drink", "diapers_and_hygiene", "pet_shop", "flowers")

# Accepted codes.
ORDER_STATUSES = ("delivered", "shipped", "canceled", "unavailable", "invoiced", "processing", "created", "approved")
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
REVIEW_SCORES = (1, 2, 3, 4, 5)
DEAD_STATUSES = ("canceled", "unavailable")

# Band edges and labels (None is an open end).
DISTANCE_EDGES, DISTANCE_LABELS = [0, 50, 200, 500, 1000, None], ["<50km", "50-200", "200-500", "500-1000", "1000+"]
DEADLINE_EDGES = [None, -15, -7, 0, 5, 10, 20, None]
DEADLINE_LABELS = ["15+ late", "7-15 late", "1-7 late", "0-5 early", "5-10 early", "10-20 early", "20+ early"]
SPEED_EDGES, SPEED_LABELS = [0, 7, 14, 21, None], ["<7 days", "7-14", "14-21", "21+"]
WEIGHT_EDGES, WEIGHT_LABELS = [0, 500, 2000, 10000, None], ["<0.5kg", "0.5-2kg", "2-10kg", "10kg+"]


@dataclass(frozen=True)
class Settings:
    window_start: str = "2017-01-01"
    window_end: str = "2018-09-01"  # exclusive
    quarters_end: str = "2018-07-01"  # exclusive end of the complete quarters
    consumables: tuple[str, ...] = CONSUMABLES
    min_category_items: int = 300
    min_state_orders: int = 200
    min_seller_orders: int = 10
    tight_buffer_days: int = 11
    heavy_weight_g: int = 30000
    dear_freight: int = 200
    big_ticket: int = 500
    runway_months: int = 12


BENCHMARK = Settings(
    window_start="1996-01-01",
    window_end="2001-07-01",
    quarters_end="2001-07-01",
    consumables=("promo", "economy"),
    heavy_weight_g=12000,
    dear_freight=2500,
    big_ticket=30000,
)
