"""Type raw columns and stamp the processing day."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from stratum.functions.casts import to_day, to_double, to_int

INGEST_DATE = "ingest_date"


def apply_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns in place; values that do not fit become NULL.

    ``date``, ``double`` and ``int`` follow :mod:`stratum.functions.casts`; any other type is a plain ``try_cast``.
    """
    typed = {}
    for name, wanted in types.items():
        value = F.col(name)
        if wanted == "date":
            typed[name] = to_day(value)
        elif wanted == "double":
            typed[name] = to_double(value)
        elif wanted in ("int", "integer"):
            typed[name] = to_int(value, from_text=isinstance(df.schema[name].dataType, StringType))
        else:
            typed[name] = value.try_cast(wanted)
    return df.withColumns(typed) if typed else df


def stamp_date(df: DataFrame, name: str = INGEST_DATE) -> DataFrame:
    return df.withColumn(name, F.current_date())
