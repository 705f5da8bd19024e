"""Predicates on dates that a scan can use."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def in_months(day: Column, months: Sequence[dt.date | None]) -> Column:
    """``day`` lies in one of ``months`` (given by their first days), or is NULL if one of them is.

    A plain range on the column itself for every run of months that follow one another: ranges reach the files, where
    the month of a day does not, and two months far apart do not read what lies between them.
    """
    runs: list[list[dt.date]] = []
    for month in sorted({m for m in months if m is not None}):
        if runs and runs[-1][1] == month:
            runs[-1][1] = _next_month(month)
        else:
            runs.append([month, _next_month(month)])
    inside = day.isNull() if None in months else F.lit(False)
    for first, after in runs:
        inside = inside | ((day >= F.lit(first)) & (day < F.lit(after)))
    return inside


def _next_month(month: dt.date) -> dt.date:
    return dt.date(month.year + month.month // 12, month.month % 12 + 1, 1)
