"""Reading and writing tables, lines and payload rows."""

from tabloom.sources.payload import flatten, from_payload, names_by_status, nested_lookup
from tabloom.sources.readers import read_delimited, read_lines, read_many, read_parquet, read_table
from tabloom.sources.sinks import write_csv, write_json, write_parquet, write_text

__all__ = [
    "flatten",
    "from_payload",
    "names_by_status",
    "nested_lookup",
    "read_delimited",
    "read_lines",
    "read_many",
    "read_parquet",
    "read_table",
    "write_csv",
    "write_json",
    "write_parquet",
    "write_text",
]
