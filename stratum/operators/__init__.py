"""DataFrame in, DataFrame out. No actions: the batch-safe ones also work on streams."""

from stratum.operators.latest import latest_by_aggregate, latest_per_key, newest_first
from stratum.operators.lineage import enrich_lineage
from stratum.operators.payload import decode_value, encode_value
from stratum.operators.rejects import has_null_key, split_null_keys
from stratum.operators.summary import Summary, refresh_summary, summarize
from stratum.operators.typed import apply_types, stamp_date
from stratum.operators.upsert import upsert_frames

__all__ = [
    "Summary",
    "apply_types",
    "decode_value",
    "encode_value",
    "enrich_lineage",
    "has_null_key",
    "latest_by_aggregate",
    "latest_per_key",
    "newest_first",
    "refresh_summary",
    "split_null_keys",
    "stamp_date",
    "summarize",
    "upsert_frames",
]
