"""Scans, sinks and the stand-in tables."""

from .quoted import scan_quoted
from .standin import coordinates, raw_enforcement, raw_lookup, raw_narratives
from .tables import (load_mart, read_table, read_text_table, tpch, write_table,
                     write_text_table)

__all__ = ["coordinates", "load_mart", "raw_enforcement", "raw_lookup", "raw_narratives",
           "read_table", "read_text_table", "scan_quoted", "tpch", "write_table", "write_text_table"]
