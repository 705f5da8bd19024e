"""Layer-to-layer jobs composed from the operators."""

from stratum.plans.gold import publish_gold, refresh_gold
from stratum.plans.ingest import ingest_all, ingest_files, ingest_messages
from stratum.plans.sales import SALES_KEYS, SALES_TYPES, daily_sales
from stratum.plans.silver import refine_to_silver, refresh_silver
from stratum.plans.sums import read_sums, refresh_sums
from stratum.plans.volumes import close_volume, compact_layer, ingest_volume, read_volumes, refine_volumes

__all__ = [
    "SALES_KEYS",
    "SALES_TYPES",
    "close_volume",
    "compact_layer",
    "daily_sales",
    "ingest_all",
    "ingest_files",
    "ingest_messages",
    "ingest_volume",
    "publish_gold",
    "read_sums",
    "read_volumes",
    "refine_to_silver",
    "refine_volumes",
    "refresh_gold",
    "refresh_silver",
    "refresh_sums",
]
