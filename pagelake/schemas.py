"""Table contracts for the five layer tables plus the extraction output.

Column order is part of the contract: writers select these names in this
order, readers re-select them after a read (partition columns come last
when Spark reads a partitioned directory).
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# Fixed values that must stay equal to the behaviour being reproduced.
# Tokens that flag a cleaned value as invalid (case-sensitive, exact match).
INVALID_TOKENS = ("N/A", "n/a", "-", "null", "None")
# Name used when a field name is null or normalises to nothing.
UNKNOWN_FIELD = "unknown_field"
# Prefix put in front of a field name that collides with a gold key column.
COLLISION_PREFIX = "field_"
# The four record kinds, in the order extraction emits them.
RECORD_TYPES = ("table_row", "paragraph", "link", "metadata")
# Layers written to the run log.
LAYERS = ("scrape", "bronze", "silver", "gold")
# The tables' columns in their order (RECORD_SCHEMA to RUN_LOG_SCHEMA, GOLD_KEYS, GOLD_STAMP below) are fixed values too.
# ---------------------------------------------------------------------------

PAYLOAD_MAP = MapType(StringType(), StringType())

# What the HTML extractor emits per record (before ids and stamps).
EXTRACT_SCHEMA = StructType([
    StructField("page_key", StringType(), True),
    StructField("source_url", StringType(), True),
    StructField("record_type", StringType(), True),
    StructField("table_index", IntegerType(), True),
    StructField("row_index", IntegerType(), True),
    StructField("extract_seq", IntegerType(), True),
    StructField("content_keys", ArrayType(StringType()), True),
    StructField("content_values", ArrayType(StringType()), True),
])

# The same with the error of a page that gives no records (all else but its key and url is null then).
TAGGED_SCHEMA = StructType([*EXTRACT_SCHEMA.fields, StructField("error", StringType(), True)])

# Pages that gave no records, and why.
QUARANTINE_SCHEMA = StructType([
    StructField("run_id", StringType(), True),
    StructField("page_key", StringType(), True),
    StructField("source_url", StringType(), True),
    StructField("error", StringType(), True),
    StructField("quarantined_at", TimestampType(), True),
])

RECORD_SCHEMA = StructType([
    StructField("record_id", StringType(), False),
    StructField("record_type", StringType(), True),
    StructField("table_index", IntegerType(), True),
    StructField("row_index", IntegerType(), True),
    StructField("content", PAYLOAD_MAP, True),
    StructField("source_url", StringType(), True),
    StructField("scraped_at", StringType(), True),
    StructField("batch_id", StringType(), True),
])

BRONZE_SCHEMA = StructType([
    StructField("record_id", StringType(), False),
    StructField("record_type", StringType(), True),
    StructField("table_index", IntegerType(), True),
    StructField("row_index", IntegerType(), True),
    StructField("content", StringType(), True),
    StructField("source_url", StringType(), True),
    StructField("scraped_at", StringType(), True),
    StructField("batch_id", StringType(), True),
    StructField("run_id", StringType(), True),
    StructField("environment", StringType(), True),
    StructField("ingestion_timestamp", TimestampType(), True),
    StructField("pipeline_layer", StringType(), True),
])

SILVER_SCHEMA = StructType([
    StructField("run_id", StringType(), True),
    StructField("silver_batch_id", StringType(), True),
    StructField("record_id", StringType(), True),
    StructField("record_type", StringType(), True),
    StructField("table_index", IntegerType(), True),
    StructField("row_index", IntegerType(), True),
    StructField("field_name", StringType(), True),
    StructField("field_value_raw", StringType(), True),
    StructField("field_value_clean", StringType(), True),
    StructField("field_value_numeric", DoubleType(), True),
    StructField("is_valid", BooleanType(), True),
    StructField("source_url", StringType(), True),
    StructField("scraped_at", StringType(), True),
    StructField("cleaned_at", TimestampType(), True),
])

# A record's parsed fields as parallel arrays (names, cleaned values, raw values): the run's own layer between bronze and silver.
FIELD_ARRAYS = ("field_name", "field_value_clean", "field_value_raw")
FIELDS_SCHEMA = StructType(
    [f for n in ("run_id", "record_id", "record_type", "table_index", "row_index", "source_url", "scraped_at") for f in SILVER_SCHEMA.fields if f.name == n]
    + [StructField(n, ArrayType(StringType()), True) for n in FIELD_ARRAYS])

GOLD_KEYS = (
    "record_id", "record_type", "table_index", "row_index",
    "source_url", "scraped_at", "run_id",
)
GOLD_STAMP = "gold_loaded_at"
# The map form's one column; reserved in the wide form too, so that runs of both forms can share a table.
GOLD_MAP = "fields"
GOLD_RESERVED = frozenset(GOLD_KEYS + (GOLD_STAMP, GOLD_MAP))

SUMMARY_SCHEMA = StructType([
    StructField("run_id", StringType(), True),
    StructField("source_url", StringType(), True),
    StructField("total_records", LongType(), True),
    StructField("total_fields", LongType(), True),
    StructField("valid_fields", LongType(), True),
    StructField("distinct_field_names", LongType(), True),
    StructField("validity_rate_pct", DoubleType(), True),
    StructField("records_by_type", StringType(), True),
    StructField("summary_generated_at", TimestampType(), True),
])

RUN_LOG_SCHEMA = StructType([
    StructField("run_id", StringType(), True),
    StructField("run_timestamp", StringType(), True),
    StructField("source_url", StringType(), True),
    StructField("layer", StringType(), True),
    StructField("status", StringType(), True),
    StructField("row_count", LongType(), True),
    StructField("message", StringType(), True),
])

PAGES_SCHEMA = StructType([
    StructField("page_id", LongType(), True),
    StructField("url", StringType(), True),
    StructField("html", StringType(), True),
])


def column_names(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields]
