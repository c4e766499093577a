"""Gold: the wide curated table and the per-run quality summary.

Wide table: one row per record that has at least one valid field, the
seven key columns, one string column per field name (sorted), and the
load stamp.  For a name that occurs more than once in a record (two raw
names that normalise alike) the smallest cleaned value is taken, so the
result does not depend on row order.

Field names come from one small distinct job; they are the output schema,
so they are the only thing brought to the driver.  Above
``spark.sql.pivotMaxValues`` names every wide form raises; the map forms
(``curated_map``, ``curated_map_in_row``: one ``fields map<string,string>``
column, named by the field names themselves) need no names and have no limit.
``curated_long_tail`` stands between: columns for the commonest names, the map for the others.
The caller chooses the form; it never depends on the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_valid_value, rate_pct
from ..params import RunParams
from ..schemas import COLLISION_PREFIX, GOLD_KEYS, GOLD_MAP, GOLD_RESERVED, GOLD_STAMP, UNKNOWN_FIELD
from .silver import RECORD_KEYS, first_valid_per_name, parsed_fields, record_field_array, spread, zipped_fields

MAP_COLUMN = GOLD_MAP


def field_names(silver: DataFrame, limit: int | None = None) -> list[str]:
    """Sorted distinct names of valid fields.  Returns at most ``limit + 1``
    names so the caller can tell that the limit is exceeded."""
    spark = silver.sparkSession
    if limit is None:
        limit = int(spark.conf.get("spark.sql.pivotMaxValues", "10000"))
    names = (silver.filter(F.col("is_valid")).select("field_name").distinct()
             .orderBy("field_name").limit(limit + 1))
    return [r[0] for r in names.collect()]


def column_plan(names: list[str]) -> list[tuple[str, str]]:
    """(field_name, gold column name) pairs.  A name equal to a key column
    (or to the load stamp) gets ``field_`` in front, repeatedly, until it
    collides with nothing."""
    taken = set(GOLD_RESERVED) | set(names)
    out = []
    for n in names:
        col = n
        if n in GOLD_RESERVED:
            col = COLLISION_PREFIX + n
            while col in taken:
                col = COLLISION_PREFIX + col
            taken.add(col)
        out.append((n, col))
    return out


def _renamed(plan: list[tuple[str, str]]):
    """field_name with colliding names replaced by their gold column name
    (only the few renamed names are spelled out)."""
    out = F.col("field_name")
    for n, c in plan:
        if n != c:
            out = F.when(F.col("field_name") == F.lit(n), F.lit(c)).otherwise(out)
    return out


def check_limit(spark, columns: int) -> None:
    limit = int(spark.conf.get("spark.sql.pivotMaxValues", "10000"))
    if columns > limit:
        raise ValueError(f"at least {columns} field names, but spark.sql.pivotMaxValues allows {limit} columns; "
                         "raise the setting or choose the map or the long_tail form of gold")


def check_names(spark, names: list[str]) -> None:
    """Raise when there are more names than a wide table may have columns."""
    check_limit(spark, len(names))


def _stamp(df: DataFrame, params: RunParams) -> DataFrame:
    return df.withColumn(GOLD_STAMP, params.run_ts_col())


def curated_wide(silver: DataFrame, params: RunParams, names: list[str] | None = None) -> DataFrame:
    """Silver (long) -> gold wide via a grouped pivot: one exchange on the
    record key; the pivot values are given, so no extra job runs."""
    if names is None:
        names = field_names(silver)
    check_names(silver.sparkSession, names)
    valid = silver.filter(F.col("is_valid"))
    if not names:
        return _stamp(valid.select(*GOLD_KEYS).distinct(), params)
    plan = column_plan(names)
    name = _renamed(plan)
    # Grouped on (run_id, record_id) only: the other key columns are
    # constant per record and ride along as min(), so the sort and the
    # hash exchange work on two short columns instead of seven.  This is
    # the plan ``pivot`` would build, written out.
    carried = [k for k in GOLD_KEYS if k not in ("run_id", "record_id")]
    aggs = [F.min(k).alias(k) for k in carried] + [
        F.min(F.when(name == F.lit(c), F.col("field_value_clean"))).alias(c) for _, c in plan]
    rows = spread(valid.select(*GOLD_KEYS, "field_name", "field_value_clean"))
    wide = rows.groupBy("run_id", "record_id").agg(*aggs)
    return _stamp(wide.select(*GOLD_KEYS, *[c for _, c in plan]), params)


def curated_wide_keys_join(silver: DataFrame, params: RunParams,
                           names: list[str] | None = None) -> DataFrame:
    """The same table in the shape of a keys table left-joined to a pivot on
    ``record_id`` alone (kept to show the join adds nothing)."""
    if names is None:
        names = field_names(silver)
    check_names(silver.sparkSession, names)
    plan = column_plan(names)
    valid = silver.filter(F.col("is_valid"))
    keys = spread(valid.select(*GOLD_KEYS)).dropDuplicates(["record_id"])
    fields = spread(valid.select("record_id", "field_name", "field_value_clean"))
    pivoted = (fields.withColumn("field_name", _renamed(plan)).withColumnRenamed("record_id", "_rid")
               .groupBy("_rid").pivot("field_name", [c for _, c in plan]).agg(F.min("field_value_clean")))
    # both sides are hash-partitioned on the record id: merge join, no broadcast
    wide = keys.join(pivoted.hint("merge"), keys["record_id"] == pivoted["_rid"], "left").drop("_rid")
    return _stamp(wide, params)


def curated_map(silver: DataFrame, params: RunParams) -> DataFrame:
    """Silver (long) -> one row per record with a map of its valid fields."""
    rows = spread(silver.filter(F.col("is_valid")).select(*GOLD_KEYS, "field_name", "field_value_clean"))
    per_name = rows.groupBy(*GOLD_KEYS, "field_name").agg(F.min("field_value_clean").alias("v"))
    fields = F.map_from_entries(F.array_sort(F.collect_list(F.struct("field_name", "v"))))
    return _stamp(per_name.groupBy(*GOLD_KEYS).agg(fields.alias(MAP_COLUMN)), params)


def _sorted_fields(bronze: DataFrame) -> DataFrame:
    """Record keys and the record's fields as one array ``_f``, sorted by name and value."""
    return bronze.select(*RECORD_KEYS, parsed_fields(F.col("content")).alias("_f"))


def _stored_fields(records: DataFrame) -> DataFrame:
    """The same from a ``record_fields`` table; the raw values are not read."""
    return records.select(*RECORD_KEYS, zipped_fields("field_name", "field_value_clean").alias("_f"))


def _record_maps(fields: DataFrame) -> DataFrame:
    """Record keys and ``_m``, the map of the record's valid fields; records without any are left out.

    The map is produced by a generator (one element, or none when the
    record has no valid field): it is built once per row and the
    emptiness test cannot be pushed below it as a second copy.
    """
    non_empty = F.filter(F.array(first_valid_per_name(F.col("_f"))), lambda m: F.size(m) > 0)
    return fields.select(*RECORD_KEYS, F.explode(non_empty).alias("_m"))


def _map_form(fields: DataFrame, params: RunParams) -> DataFrame:
    return _stamp(_record_maps(fields).select(*GOLD_KEYS, F.col("_m").alias(MAP_COLUMN)), params)


def _wide_form(fields: DataFrame, params: RunParams, names: list[str]) -> DataFrame:
    cols = [F.element_at("_m", F.lit(n)).alias(c) for n, c in column_plan(names)]
    return _stamp(_record_maps(fields).select(*GOLD_KEYS, *cols), params)


def curated_map_in_row(bronze: DataFrame, params: RunParams) -> DataFrame:
    """The map form straight from bronze rows, without any exchange."""
    return _map_form(_sorted_fields(bronze), params)


def curated_map_of_fields(records: DataFrame, params: RunParams) -> DataFrame:
    """The map form from a ``record_fields`` table."""
    return _map_form(_stored_fields(records), params)


def curated_wide_in_row(bronze: DataFrame, params: RunParams, names: list[str]) -> DataFrame:
    """Gold wide straight from bronze rows without any exchange.

    Each bronze row holds all fields of its record; the valid fields are
    parsed and cleaned exactly as silver does and looked up by name.
    """
    check_names(bronze.sparkSession, names)
    return _wide_form(_sorted_fields(bronze), params, names)


def curated_wide_of_fields(records: DataFrame, params: RunParams, names: list[str]) -> DataFrame:
    """Gold wide from a ``record_fields`` table: no exchange, nothing is parsed, raw values are not read."""
    check_names(records.sparkSession, names)
    return _wide_form(_stored_fields(records), params, names)


def head_names(records: DataFrame, columns: int) -> list[str]:
    """The ``columns`` field names that most records have a valid value for, commonest first, ties by name.

    Counted exactly from a ``record_fields`` table: names fold on the map side, a name is counted once per record, and
    only the chosen ones reach the driver, however many there are.
    """
    if columns < 0:
        raise ValueError(f"columns must not be negative, got {columns}")
    check_limit(records.sparkSession, columns)
    if columns == 0:
        return []
    names = _record_maps(_stored_fields(records)).select(F.explode(F.map_keys("_m")).alias("name"))
    top = names.groupBy("name").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "name").limit(columns)
    return [r.name for r in top.collect()]


def curated_long_tail(records: DataFrame, params: RunParams, heads: list[str]) -> DataFrame:
    """Gold with one column per name of ``heads`` and the record's other valid fields in the map ``fields``.

    From a ``record_fields`` table, without any exchange and for any number of names; no name is lost. The map is
    empty when the columns hold all of a record's fields. Without heads this is the map form.
    """
    check_names(records.sparkSession, heads)
    cols = [F.element_at("_m", F.lit(n)).alias(c) for n, c in column_plan(heads)]
    rest = F.map_filter("_m", lambda k, _: ~k.isin(*heads)) if heads else F.col("_m")
    return _stamp(_record_maps(_stored_fields(records)).select(*GOLD_KEYS, *cols, rest.alias(MAP_COLUMN)), params)


def run_summary(silver: DataFrame, params: RunParams, sources: DataFrame | None = None) -> DataFrame:
    """One quality row per (run, source): records, fields, valid fields,
    distinct names, validity rate, and ``type=n`` counts sorted by type.

    Two aggregates over the same rows, each with partial (map-side)
    aggregation: per (run, source, type) the distinct records, fields and
    valid fields, folded per source; and per (run, source) the distinct
    field names.  Distinct counts are exchanged on (keys, record id / field
    name) first, so a source holding a large share of the rows is spread
    over all tasks and only partial counts reach the per-source step.  The
    two results meet in one more grouping on (run, source), not in a join, so
    a null source keeps its row.  With ``sources`` (a frame of
    ``source_url``), sources that produced nothing are added as empty
    marker rows and get a row of zeros, without a join against the pages.
    """
    gk = ["run_id", "source_url"]
    rows = silver.select(
        *gk, F.coalesce(F.col("record_type"), F.lit("None")).alias("record_type"),
        "record_id", "field_name", "is_valid")
    if sources is not None:
        rows = rows.unionByName(sources.select(
            F.lit(params.run_id).alias("run_id"), "source_url",
            F.lit(None).cast("string").alias("record_type"), F.lit(None).cast("string").alias("record_id"),
            F.lit(None).cast("string").alias("field_name"), F.lit(None).cast("boolean").alias("is_valid")))
    per_type = rows.groupBy(*gk, "record_type").agg(
        F.count_distinct("record_id").alias("n_records"),
        F.count("field_name").alias("n_fields"),
        F.count_if("is_valid").alias("n_valid"),
    )
    by_type = F.when(F.col("n_records") > 0, F.struct("record_type", "n_records"))
    # distinct names of a source, counted as rows of the same final grouping
    seen = rows.select(*gk, "field_name").where(F.col("field_name").isNotNull()).distinct()
    none = F.lit(None).cast("long")
    parts = per_type.withColumn("one_name", none).unionByName(seen.select(
        *gk, F.lit(None).cast("string").alias("record_type"), none.alias("n_records"), none.alias("n_fields"),
        none.alias("n_valid"), F.lit(1).cast("long").alias("one_name")))
    per_source = parts.groupBy(*gk).agg(
        F.sum("n_records").alias("total_records"),
        F.sum("n_fields").alias("total_fields"),
        F.sum("n_valid").alias("valid_fields"),
        F.array_join(F.transform(F.array_sort(F.collect_list(by_type)),
                                 lambda x: F.concat(x["record_type"], F.lit("="), x["n_records"].cast("string"))),
                     ", ").alias("records_by_type"),
        F.sum("one_name").alias("distinct_field_names"),
    )
    return _summary_rows(per_source, params)


def run_summary_in_row(bronze: DataFrame, params: RunParams, sources: DataFrame | None = None) -> DataFrame:
    """The summary of ``run_summary`` straight from bronze rows, whose record ids must be unique."""
    return _summary_of(record_field_array(bronze).withColumnRenamed("fields", "_f"), params, sources)


def run_summary_of_fields(records: DataFrame, params: RunParams, sources: DataFrame | None = None) -> DataFrame:
    """The same from a ``record_fields`` table: nothing is parsed, raw values are not read."""
    return _summary_of(_stored_fields(records), params, sources)


def _summary_of(records: DataFrame, params: RunParams, sources: DataFrame | None) -> DataFrame:
    """A row gives one marker for its record and its fields by name; these fold on the map side to one row per
    (source, type, name), so record ids are never exchanged. One scan, three exchanges: by
    (source, type, name), by (source, name) for the distinct names, by source.
    """
    gk = ["run_id", "source_url"]
    # as in silver, a record without fields keeps one unknown, invalid field
    fields = F.filter("_f", lambda x: x["field_name"].isNotNull())
    none = F.array(F.struct(F.lit(UNKNOWN_FIELD).alias("name"), F.lit(0).cast("long").alias("records"), F.lit(1).cast("long").alias("fields"), F.lit(0).cast("long").alias("valid")))
    named = F.transform(fields, lambda x: F.struct(x["field_name"].alias("name"), F.lit(0).cast("long").alias("records"),
                                                   F.lit(1).cast("long").alias("fields"), is_valid_value(x["field_value_clean"]).cast("long").alias("valid")))
    marker = F.array(F.struct(F.lit(None).cast("string").alias("name"), F.lit(1).cast("long").alias("records"), F.lit(0).cast("long").alias("fields"), F.lit(0).cast("long").alias("valid")))
    parts = F.concat(marker, F.when(F.size("_f") > 0, named).otherwise(none))
    rows = records.select(*gk, F.coalesce("record_type", F.lit("None")).alias("record_type"), F.inline(parts))
    if sources is not None:
        zero = F.lit(0).cast("long")
        rows = rows.unionByName(sources.select(
            F.lit(params.run_id).alias("run_id"), "source_url", F.lit(None).cast("string").alias("record_type"),
            F.lit(None).cast("string").alias("name"), zero.alias("records"), zero.alias("fields"), zero.alias("valid")))
    folded = rows.groupBy(*gk, "record_type", "name").agg(*[F.sum(c).alias(c) for c in ("records", "fields", "valid")])
    by_type = F.when(F.col("records") > 0, F.struct("record_type", "records"))
    per_source = folded.groupBy(*gk).agg(
        F.sum("records").alias("total_records"), F.sum("fields").alias("total_fields"), F.sum("valid").alias("valid_fields"),
        F.array_join(F.transform(F.array_sort(F.collect_list(by_type)),
                                 lambda x: F.concat(x["record_type"], F.lit("="), x["records"].cast("string"))), ", ").alias("records_by_type"),
        F.count_distinct("name").alias("distinct_field_names"))
    return _summary_rows(per_source, params)


def _summary_rows(per_source: DataFrame, params: RunParams) -> DataFrame:
    zero = F.lit(0).cast("long")
    return per_source.select(
        "run_id",
        "source_url",
        F.coalesce("total_records", zero).cast("long").alias("total_records"),
        F.coalesce("total_fields", zero).cast("long").alias("total_fields"),
        F.coalesce("valid_fields", zero).cast("long").alias("valid_fields"),
        F.coalesce("distinct_field_names", zero).cast("long").alias("distinct_field_names"),
        rate_pct(F.coalesce("valid_fields", zero), F.coalesce("total_fields", zero)).alias("validity_rate_pct"),
        F.coalesce("records_by_type", F.lit("")).alias("records_by_type"),
        params.run_ts_col().alias("summary_generated_at"),
    )


def records_by_type(silver: DataFrame) -> DataFrame:
    """Distinct records per (run, source, record type)."""
    return silver.groupBy("run_id", "source_url", "record_type").agg(
        F.count_distinct("record_id").alias("record_count"))
