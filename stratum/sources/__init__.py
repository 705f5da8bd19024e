"""Reading: files as they arrive, message topics, stored layers, schemas."""

from stratum.sources.files import stream_files
from stratum.sources.messages import message_options, sasl_plain_options, stream_messages
from stratum.sources.schemas import load_schema, named_columns, recorded_layer, text_first, track_schema
from stratum.sources.tables import read_layer, table_exists

__all__ = [
    "load_schema",
    "message_options",
    "named_columns",
    "read_layer",
    "recorded_layer",
    "sasl_plain_options",
    "stream_files",
    "stream_messages",
    "table_exists",
    "text_first",
    "track_schema",
]
