"""Writing results and previewing them."""

from washline.sinks.csv import write_object_csv
from washline.sinks.preview import preview
from washline.sinks.tables import write_branches, write_table, write_table_jdbc

__all__ = ["preview", "write_branches", "write_object_csv", "write_table", "write_table_jdbc"]
