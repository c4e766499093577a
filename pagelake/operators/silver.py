"""Silver: parse the payload, one row per (record, field), cleaned and flagged.

Two forms with the same result:

* ``to_silver`` (default) works inside each bronze row.  All fields of a
  record live in one bronze row, so the payload is parsed, every field is
  cleaned, and duplicates are removed with array functions before the row
  is exploded.  No exchange at all; valid because ``record_id`` is unique
  per bronze row (it hashes the batch and the record's position).
  A run parses once: ``record_fields`` is that per-record form as a table (three parallel
  arrays, so a reader of names and cleaned values doesn't read the raw ones); silver, gold and
  summary start from it (``silver_of_fields``).
* ``to_silver_relational`` brings the rows of a record together (``spread``: one
  hash exchange, of unexploded rows), explodes and removes duplicates with a
  grouped aggregate on ``(record, field_name, field_value_clean)``.  Kept as the cross-check for the in-row form and for
  inputs whose record ids may repeat.

Duplicate rule: among fields of one record with equal normalised name and
equal cleaned value, the one earliest in the payload is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean_whitespace, is_valid_value, numeric_value, snake_case_name
from ..params import RunParams
from ..schemas import FIELD_ARRAYS, PAYLOAD_MAP, SILVER_SCHEMA, UNKNOWN_FIELD, column_names

SILVER_COLUMNS = column_names(SILVER_SCHEMA)
RECORD_KEYS = ("run_id", "record_id", "record_type", "table_index", "row_index",
               "source_url", "scraped_at")


def _let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and hand it to ``fn`` (a one-element array
    mapped with a lambda): lets a lambda refer to its own input array."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` hash-partitioned on ``record_id`` into as many tasks as the session shuffles into, none of them merged.

    For a grouping on the record (and more) whose aggregates are texts: Spark sorts for these, on the map side all rows of a
    scan split, which one parquet row group or file can make most of a table.  After this exchange the
    rows are sorted where they are grouped, a share of the table in each task, and the grouping needs no other exchange.
    Not on the other keys: those that are literals leave a grouping's keys, and it would exchange its rows again.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "record_id")


def parsed_fields(content: Column) -> Column:
    """JSON payload -> ``array<struct<field_name, field_value_clean,
    field_position, field_value_raw>>`` sorted by name, value, position.

    A payload that is not a JSON object gives null; ``{}`` gives ``[]``.
    """
    entries = F.map_entries(F.from_json(content, PAYLOAD_MAP))
    fields = F.transform(entries, lambda e, i: F.struct(
        snake_case_name(e["key"]).alias("field_name"),
        clean_whitespace(e["value"]).alias("field_value_clean"),
        i.alias("field_position"),
        e["value"].alias("field_value_raw"),
    ))
    return F.sort_array(fields)


def distinct_fields(sorted_fields: Column) -> Column:
    """Keep the first element of each (name, cleaned value) run of a
    sorted field array: the earliest payload position."""
    return _let(sorted_fields, lambda s: F.filter(s, lambda x, i: (i == 0) | (
        (F.get(s, i - 1)["field_name"] != x["field_name"])
        | (F.get(s, i - 1)["field_value_clean"] != x["field_value_clean"]))))


def first_valid_per_name(sorted_fields: Column) -> Column:
    """``map<name, value>`` of a record's valid fields; for a name present
    more than once the smallest cleaned value is taken."""
    valid = F.filter(sorted_fields, lambda x: is_valid_value(x["field_value_clean"]))
    firsts = _let(valid, lambda s: F.filter(
        s, lambda x, i: (i == 0) | (F.get(s, i - 1)["field_name"] != x["field_name"])))
    return F.map_from_entries(F.transform(
        firsts, lambda x: F.struct(x["field_name"], x["field_value_clean"])))


def record_field_array(bronze: DataFrame) -> DataFrame:
    """Bronze -> one row per record with the cleaned, de-duplicated fields
    as an array column ``fields`` (the record-level silver form)."""
    return bronze.select(*RECORD_KEYS, distinct_fields(parsed_fields(F.col("content"))).alias("fields"))


def record_fields(bronze: DataFrame) -> DataFrame:
    """Bronze -> one row per record with the arrays ``FIELD_ARRAYS``, parallel and ordered by name and value (null
    arrays where the payload isn't a JSON object): the table that silver, gold and summary of a run read.

    A raw value that equals its non-empty cleaned value is left out (null), since most do; ``raw_value`` puts it back.
    """
    rec = record_field_array(bronze)
    raw = F.transform("fields", lambda x: F.when((x["field_value_raw"] == x["field_value_clean"]) & (x["field_value_clean"] != ""), F.lit(None).cast("string"))
                      .otherwise(x["field_value_raw"]))
    return rec.select(*RECORD_KEYS, F.col("fields.field_name").alias("field_name"), F.col("fields.field_value_clean").alias("field_value_clean"),
                      raw.alias("field_value_raw"))


def raw_value(stored, clean) -> Column:
    """The raw value of a ``record_fields`` entry: a missing one beside an empty cleaned value was null, any other equals the cleaned value."""
    return F.when(stored.isNull() & (clean != ""), clean).otherwise(stored)


def zipped_fields(*columns: str) -> Column:
    """The named arrays of a ``record_fields`` row as one array of structs; only these are read."""
    return F.arrays_zip(*columns)


def _finish(df: DataFrame, params: RunParams) -> DataFrame:
    clean = F.coalesce(F.col("field_value_clean"), F.lit(""))
    return df.select(
        F.col("run_id"),
        F.lit(params.run_id).alias("silver_batch_id"),
        F.col("record_id"),
        F.col("record_type"),
        F.col("table_index"),
        F.col("row_index"),
        F.coalesce(F.col("field_name"), F.lit(UNKNOWN_FIELD)).alias("field_name"),
        F.col("field_value_raw"),
        clean.alias("field_value_clean"),
        numeric_value(clean).alias("field_value_numeric"),
        is_valid_value(clean).alias("is_valid"),
        F.col("source_url"),
        F.col("scraped_at"),
        params.run_ts_col().alias("cleaned_at"),
    )


def to_silver(bronze: DataFrame, params: RunParams) -> DataFrame:
    """Bronze -> silver (14 columns, fixed order), in-row: no exchange."""
    rec = record_field_array(bronze)
    exploded = rec.select(*RECORD_KEYS, F.inline_outer("fields"))
    return _finish(exploded, params)


def silver_of_fields(records: DataFrame, params: RunParams) -> DataFrame:
    """Same result as ``to_silver`` from a ``record_fields`` table: nothing is parsed."""
    exploded = records.select(*RECORD_KEYS, F.inline_outer(zipped_fields(*FIELD_ARRAYS)))
    return _finish(exploded.withColumn("field_value_raw", raw_value(F.col("field_value_raw"), F.col("field_value_clean"))), params)


def to_silver_relational(bronze: DataFrame, params: RunParams) -> DataFrame:
    """Same result as ``to_silver`` via explode + grouped de-duplication."""
    parsed = spread(bronze.select(*RECORD_KEYS, "content")).select(*RECORD_KEYS, F.from_json("content", PAYLOAD_MAP).alias("m"))
    exploded = parsed.select(*RECORD_KEYS, F.posexplode_outer("m").alias("pos", "k", "v"))
    cleaned = exploded.select(
        *RECORD_KEYS,
        snake_case_name("k").alias("field_name"),
        clean_whitespace("v").alias("field_value_clean"),
        F.col("pos"),
        F.col("v").alias("field_value_raw"),
    )
    dedup = cleaned.groupBy(*RECORD_KEYS, "field_name", "field_value_clean").agg(
        F.min_by("field_value_raw", "pos").alias("field_value_raw"))
    return _finish(dedup, params)


def quality_counts(silver: DataFrame) -> DataFrame:
    """One row: total, valid and invalid field rows (a single aggregate)."""
    return silver.agg(
        F.count(F.lit(1)).alias("total_fields"),
        F.count_if("is_valid").alias("valid_fields"),
    ).withColumn("invalid_fields", F.col("total_fields") - F.col("valid_fields"))
