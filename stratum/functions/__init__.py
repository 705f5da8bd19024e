"""Column expressions: no plans, no actions."""

from stratum.functions.casts import to_day, to_double, to_int
from stratum.functions.dates import in_months
from stratum.functions.names import free_name, free_names, quoted
from stratum.functions.payload import field_of, json_payload, row_json, text_payload, undeclared_fields

__all__ = [
    "field_of",
    "free_name",
    "free_names",
    "in_months",
    "json_payload",
    "quoted",
    "row_json",
    "text_payload",
    "to_day",
    "to_double",
    "to_int",
    "undeclared_fields",
]
