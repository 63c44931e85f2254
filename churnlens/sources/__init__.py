from churnlens.sources.parts import list_parts, load_parts, part_row_counts, verify_row_count
from churnlens.sources.retail_view import (
    export_raw_parts,
    raw_transactions_from_tables,
)
from churnlens.sources.tables import TableTarget, read_report_json, write_report_json

__all__ = [
    "TableTarget",
    "export_raw_parts",
    "list_parts",
    "load_parts",
    "part_row_counts",
    "raw_transactions_from_tables",
    "read_report_json",
    "verify_row_count",
    "write_report_json",
]
