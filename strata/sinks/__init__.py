"""Sinks: writers registry, partitioned overwrite, keyed (upsert) tables."""

from .keyed_table import merge_into, read_keyed_table, write_keyed_table
from .writers import get_writer, register_writer, write_spec

__all__ = ["get_writer", "merge_into", "read_keyed_table", "register_writer", "write_keyed_table", "write_spec"]
