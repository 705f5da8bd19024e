"""The sales dataset: its key, its types, its daily summary."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from stratum.functions import in_months, to_day
from stratum.operators import Summary

SALES_KEYS = ("order_id",)
SALES_TYPES = {"order_date": "date", "price": "double", "quantity": "int"}


def daily_sales(by_month: bool = False) -> Summary:
    """Revenue and units per day and region; ``by_month`` adds the month, to partition by where days are too fine."""
    day = to_day(F.col("order_date"))
    month = {"order_month": F.trunc(day, "MM")} if by_month else {}
    return Summary(
        dims={"order_day": day, "region": F.col("region"), **month},
        within={"order_month": partial(in_months, day)},
        sums={
            "total_revenue": F.col("quantity") * F.col("price"),
            "total_units": F.col("quantity"),
        },
    )
