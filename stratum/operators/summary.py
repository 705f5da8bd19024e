"""Grouped sums, full or refreshed for the groups that changed."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from stratum.functions.names import free_name


@dataclass(frozen=True)
class Summary:
    """What to group by and what to sum, as expressions over the detail rows.

    ``within`` may name, for a dimension, a predicate that holds for all rows with one of the given values of it: one
    that a scan can use where the dimension's own expression is out of its reach.
    """

    dims: Mapping[str, Column]
    sums: Mapping[str, Column]
    within: Mapping[str, Callable[[Sequence[Any]], Column]] = field(default_factory=dict)


def summarize(df: DataFrame, summary: Summary) -> DataFrame:
    """Sums per group. NULL is a group of its own; NULL terms are skipped; a group with only NULL terms sums to NULL."""
    dims = [c.alias(name) for name, c in summary.dims.items()]
    return df.groupBy(*dims).agg(*(F.sum(c).alias(name) for name, c in summary.sums.items()))


def refresh_summary(
    old: DataFrame, detail: DataFrame, summary: Summary, dim: str, touched: DataFrame
) -> DataFrame:
    """Equal to ``summarize(detail, summary)`` when only groups with a touched ``dim`` have changed since ``old``.

    ``touched`` has one column: the new and the previous values of the changed rows, NULL included. A value without
    detail rows vanishes from the result.
    """
    name = free_name("_touched", [*old.columns, *detail.columns])
    changed = touched.select(F.col(touched.columns[0]).alias(name)).distinct()
    kept = old.join(changed, F.col(dim).eqNullSafe(F.col(name)), "left_anti")
    again = detail.join(changed, summary.dims[dim].eqNullSafe(F.col(name)), "left_semi")
    return kept.unionByName(summarize(again, summary))
