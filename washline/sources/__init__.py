"""Reading delimited files, listing and hashing files, probing sources."""

from washline.sources.csv import dedupe_header, read_csv_table, read_object_csv
from washline.sources.files import file_checksums, land_files, list_files
from washline.sources.probe import classify_read_error, probe_source

__all__ = [
    "classify_read_error",
    "dedupe_header",
    "file_checksums",
    "land_files",
    "list_files",
    "probe_source",
    "read_csv_table",
    "read_object_csv",
]
