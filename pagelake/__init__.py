"""pagelake: web pages (or any JSON payload table) -> bronze / silver / gold
tables, as Spark DataFrame jobs."""

from .params import RunParams, TableNames, mode_for

__all__ = ["RunParams", "TableNames", "mode_for"]
__version__ = "0.1.0"
