"""Sources: readers, date templates, incremental scans, driver-table adapters."""

from .paths import after_date, incremental, resolve_date_range, resolve_date_template
from .readers import get_reader, is_missing_path, read, read_spec, register_reader

__all__ = [
    "after_date",
    "get_reader",
    "incremental",
    "is_missing_path",
    "read",
    "read_spec",
    "register_reader",
    "resolve_date_range",
    "resolve_date_template",
]
