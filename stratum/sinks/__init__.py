"""Writing: catalog tables, keyed tables, files, messages."""

from stratum.sinks.files import export_json, write_layer
from stratum.sinks.keyed import upsert_table
from stratum.sinks.messages import publish_messages
from stratum.sinks.pending import append_rows, fold_large, fold_rows, pending_files, read_current, settle_rows
from stratum.sinks.tables import ensure_namespace, publish_table, publish_view

__all__ = [
    "append_rows",
    "ensure_namespace",
    "export_json",
    "fold_large",
    "fold_rows",
    "pending_files",
    "publish_messages",
    "publish_table",
    "publish_view",
    "read_current",
    "settle_rows",
    "upsert_table",
    "write_layer",
]
