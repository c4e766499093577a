from .extract import extract_raw, extract_records, payload_records, read_pages
from .tables import TableStore, encode_complex, ensure_database, read_table, write_jdbc

__all__ = [
    "TableStore",
    "encode_complex",
    "ensure_database",
    "extract_raw",
    "extract_records",
    "payload_records",
    "read_pages",
    "read_table",
    "write_jdbc",
]
