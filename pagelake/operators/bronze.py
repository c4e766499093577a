"""Bronze: land records as they came, with lineage columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import RunParams
from ..schemas import BRONZE_SCHEMA, column_names
from ..sources.extract import content_json

BRONZE_COLUMNS = column_names(BRONZE_SCHEMA)


def to_bronze(records: DataFrame, params: RunParams) -> DataFrame:
    """Records -> bronze rows (12 columns, fixed order).

    A map/struct payload is JSON-encoded (a missing one becomes ``null``);
    text payloads are kept as they are.  A record without an id is an
    error.  Audit columns are literals of the
    run, so the whole layer is one narrow projection: no shuffle.
    """
    ctype = records.schema["content"].dataType.typeName()
    content = F.col("content") if ctype == "string" else content_json(F.col("content"))
    rid = F.col("record_id")
    return records.select(
        # the id is the table's non-null key: a record without one fails the job
        F.when(rid.isNull(), F.raise_error(F.lit("bronze: record_id is null"))).otherwise(rid)
        .alias("record_id"),
        F.col("record_type"),
        F.col("table_index").cast("int").alias("table_index"),
        F.col("row_index").cast("int").alias("row_index"),
        content.alias("content"),
        F.col("source_url"),
        F.col("scraped_at"),
        F.col("batch_id"),
        F.lit(params.run_id).alias("run_id"),
        F.lit(params.environment).alias("environment"),
        params.run_ts_col().alias("ingestion_timestamp"),
        F.lit("bronze").alias("pipeline_layer"),
    )
