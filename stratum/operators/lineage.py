"""Where a row came from and when it arrived."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

# The names of the raw layer's own columns and of the two kinds of source.
INGEST_TIMESTAMP = "ingest_timestamp"
SOURCE_SYSTEM = "source_system"
SOURCE_FILE = "source_file"
FILE_SYSTEM = "file"
MESSAGE_SYSTEM = "kafka"

LINEAGE_COLUMNS = (INGEST_TIMESTAMP, SOURCE_SYSTEM, SOURCE_FILE)


def enrich_lineage(df: DataFrame, source_system: str, file_metadata: bool | None = None) -> DataFrame:
    """Add ingest time, source system and source file.

    The file is read from the scan's own metadata column, so ``df`` must come straight from a file scan when
    ``file_metadata`` is true (the default for the ``file`` system); otherwise the column is a typed NULL.
    """
    if file_metadata is None:
        file_metadata = source_system == FILE_SYSTEM
    if file_metadata:
        try:
            df.select("_metadata.file_path")
        except AnalysisException as e:
            raise ValueError("file lineage needs a DataFrame that reads files directly: it has no _metadata") from e
        source_file = F.col("_metadata.file_path")
    else:
        source_file = F.lit(None).cast("string")
    enriched = df.withColumns(
        {
            INGEST_TIMESTAMP: F.current_timestamp(),
            SOURCE_SYSTEM: F.lit(source_system),
            SOURCE_FILE: source_file,
        }
    )
    # Hidden in a plain scan (nothing to drop), an ordinary column where the scan was projected.
    return enriched.drop("_metadata")
