"""Upsert as a relational expression over two frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stratum.functions.names import free_name, quoted
from stratum.operators.rejects import split_null_keys


def upsert_frames(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``source`` merged in on equal keys.

    Matched rows are replaced as a whole, unmatched rows are inserted, nothing is deleted. A NULL in a key matches
    nothing, so such rows stay or are inserted. Several source rows for one target row raise an error when the result
    is computed, as a merge does.

    The source is counted per key first (map-side combined, so repeated keys do not pile up in one task) and the counts
    are joined to the target on the same partitioning. Target rows with a NULL key can match nothing; they bypass the
    join instead of meeting in one task.
    """
    keys = list(keys)
    keyed_source, _ = split_null_keys(source, keys)
    keyed, keyless = split_null_keys(target, keys)
    counted = free_name("_matches", target.columns)
    matches = keyed_source.groupBy(*map(quoted, keys)).agg(F.count("*").alias(counted))
    n = F.col(counted)
    unmatched = (
        F.when(n.isNull(), F.lit(True))
        .when(n == 1, F.lit(False))
        .otherwise(F.raise_error(F.lit("several source rows match one target row")).cast("boolean"))
    )
    kept = keyed.join(matches, keys, "left").where(unmatched).select(*map(quoted, target.columns))
    return kept.unionByName(keyless).unionByName(source)
