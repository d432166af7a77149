"""Readers (CSV families, file listings, images) and table writers."""

from corvid.sources.csv import read_header_csv, read_headerless_csv, read_indexed_csv, read_year_files
from corvid.sources.images import list_files, read_images
from corvid.sources.sinks import append_delta, compact, read_merged, write_keyed_table, write_partitioned

__all__ = ["read_header_csv", "read_headerless_csv", "read_indexed_csv", "read_year_files",
           "list_files", "read_images", "read_merged", "append_delta", "compact", "write_keyed_table",
           "write_partitioned"]
