"""BI read queries over the layer tables (what the dashboard asks)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import js_number_prefix, rate_pct
from ..schemas import GOLD_KEYS, GOLD_STAMP

PREVIEW_ROWS = 50
CONSOLE_ROWS = 10


def record_type_counts(bronze: DataFrame) -> DataFrame:
    """Records per type, by type name; null types left out."""
    return (bronze.filter(F.col("record_type").isNotNull())
            .groupBy("record_type").agg(F.count(F.lit(1)).alias("record_count"))
            .orderBy("record_type"))


def gold_preview(gold: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """First ``n`` curated rows by key, without the load stamp (a top-n:
    Spark plans it as TakeOrderedAndProject, no full sort)."""
    cols = [c for c in gold.columns if c != GOLD_STAMP]
    return gold.select(*[F.col(f"`{c}`") for c in cols]).orderBy("source_url", "record_id").limit(n)


def display_rows(df: DataFrame) -> DataFrame:
    """Every cell as display text, nulls shown as blanks."""
    return df.select(*[
        F.coalesce(F.col(f"`{f.name}`") if isinstance(f.dataType, StringType)
                   else F.col(f"`{f.name}`").cast("string"), F.lit("")).alias(f.name)
        for f in df.schema.fields])


def layer_stats(bronze: DataFrame, silver: DataFrame, gold: DataFrame,
                summary: DataFrame) -> DataFrame:
    """One row: bronze rows, silver rows, validity %, curated records (as
    counted by the summary, i.e. including records with no valid field)
    and the rows actually in the wide table.

    Each input is reduced to one (metric, value) row and the four are
    folded into a single row by one aggregate.
    """
    parts = [
        bronze.agg(F.lit("bronze_count").alias("m"), F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("d")),
        silver.agg(F.lit("silver_count").alias("m"), F.count(F.lit(1)).alias("n"),
                   F.count_if("is_valid").cast("long").alias("d")),
        summary.agg(F.lit("summary_records").alias("m"), F.sum("total_records").alias("n"), F.lit(0).cast("long").alias("d")),
        gold.agg(F.lit("gold_rows").alias("m"), F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("d")),
    ]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)

    def pick(name, col="n"):
        return F.coalesce(F.max(F.when(F.col("m") == name, F.col(col))), F.lit(0)).cast("long")

    return u.agg(
        pick("bronze_count").alias("bronze_count"),
        pick("silver_count").alias("silver_count"),
        rate_pct(pick("silver_count", "d"), pick("silver_count")).alias("silver_validity_pct"),
        pick("summary_records").alias("gold_count"),
        pick("gold_rows").alias("gold_rows"),
    )


def chart_series(gold: DataFrame, x_col: str, y_col: str) -> DataFrame:
    """Rows whose y parses as a number by prefix (like ``parseFloat``);
    label = x or blank."""
    y = js_number_prefix(F.col(f"`{y_col}`"))
    return (gold.select(F.coalesce(F.col(f"`{x_col}`").cast("string"), F.lit("")).alias("label"),
                        y.alias("value"))
            .filter(F.col("value").isNotNull()))


def gold_for_url(gold: DataFrame, url: str) -> DataFrame:
    """Curated rows of one source, newest load first."""
    return gold.filter(F.col("source_url") == F.lit(url)).orderBy(F.col(GOLD_STAMP).desc())


def latest_gold_per_url(gold: DataFrame) -> DataFrame:
    """For every source, the rows of its most recent load.

    The latest stamp per source is a partial aggregate (one row per
    source) semi-joined back on (source, stamp); no window over a source,
    so a source with a huge share of rows is never funnelled into one
    task.  No hint: adaptive execution broadcasts the per-source side if it
    measures small, else the join is shuffled and a skewed source's
    partition is split.  A null source is a source.
    """
    latest = gold.groupBy(F.col("source_url").alias("_url")).agg(F.max(GOLD_STAMP).alias("_at"))
    return gold.join(latest, F.col("source_url").eqNullSafe(F.col("_url")) & (F.col(GOLD_STAMP) == F.col("_at")), "left_semi")


def summary_latest_first(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.col("summary_generated_at").desc(), "source_url")


def run_log_latest_first(run_log: DataFrame) -> DataFrame:
    return run_log.orderBy(F.col("run_timestamp").desc(), "layer")


def console_preview(df: DataFrame, n: int = CONSOLE_ROWS) -> DataFrame:
    return df.limit(n)


__all__ = [
    "GOLD_KEYS",
    "chart_series",
    "console_preview",
    "display_rows",
    "gold_for_url",
    "gold_preview",
    "latest_gold_per_url",
    "layer_stats",
    "record_type_counts",
    "run_log_latest_first",
    "summary_latest_first",
]
