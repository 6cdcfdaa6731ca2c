"""Small hand-made suppliers for unit tests."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from vendorium.schemas import BUSINESS_COLUMNS, RAW_SUPPLIERS

GOOD = {
    "supplier_id": "S1",
    "supplier_name": " acme ",
    "country_code": "de",
    "region": "emea",
    "category": "mro",
    "contract_value_usd": Decimal("100.00"),
    "lead_time_days": 10,
    "quality_score": Decimal("80.00"),
    "on_time_delivery_pct": Decimal("70.00"),
    "risk_rating": "low",
    "last_audit_date": date(2024, 1, 15),
    "is_active": True,
}


def batch_time(number: int) -> datetime:
    return datetime(2024, 1, 1, 0, 5 * number)


def raw_rows(spark, *changes: dict, batch: int = 1):
    """One raw row per dict, each a good row with the given cells changed."""
    rows = []
    for number, change in enumerate(changes, start=1):
        cells = {**GOOD, **change}
        lineage = (f"raw/b{batch}.csv", number, batch_time(batch), f"b{batch}", "LOADED")
        rows.append(tuple(cells[name] for name in BUSINESS_COLUMNS) + lineage)
    return spark.createDataFrame(rows, RAW_SUPPLIERS)
