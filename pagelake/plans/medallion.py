"""End-to-end run: pages -> bronze -> silver -> gold (+ summary, run log).

Each layer is written, then the next layer reads the written table's
partition for this run.  That makes every layer durable before the next
starts, cuts lineage at each table (a lost executor recomputes at most
one layer), and lets Spark prune to the run's files.

Plan shape per layer (no driver collection except the gold field names):

* scrape: scan pages -> mapInArrow parse -> write records and errors.  No shuffle (pages that
  occur twice are found by one count over their ids and urls).
* bronze: scan the run's scrape table -> project -> write; errors -> quarantine and run log.
* fields: scan bronze(run) -> parse/clean/dedup inside each row -> write arrays per record.  The
  run's only JSON parse; no shuffle.  The table goes when gold is written.
* silver: scan fields(run) -> explode -> write.  No shuffle.
* gold names: scan silver(run) [field_name, is_valid] -> distinct (partial
  aggregate) -> at most pivotMaxValues + 1 names to the driver.
* gold wide: scan fields(run) without raw values -> valid-field map per row -> one column per
  name -> write.  No shuffle.  (``in_row_gold=False`` uses the grouped
  pivot over silver instead: one exchange.)
* summary: scan fields(run) without raw values -> record markers and fields, folded by (source, type, name),
  then by source.  No join.
"""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..operators.bronze import BRONZE_COLUMNS, to_bronze
from ..operators.gold import (
    column_plan, curated_long_tail, curated_map, curated_map_of_fields, curated_wide, curated_wide_of_fields, field_names, head_names, run_summary,
    run_summary_of_fields)
from ..operators.silver import SILVER_COLUMNS, record_fields, silver_of_fields
from ..params import RunParams, mode_for
from ..schemas import (
    BRONZE_SCHEMA, FIELDS_SCHEMA, GOLD_KEYS, GOLD_MAP, GOLD_STAMP, PAYLOAD_MAP, SILVER_SCHEMA, SUMMARY_SCHEMA, TAGGED_SCHEMA, column_names)
from ..sources.extract import distinct_pages, extract_tagged, quarantined, records_only, stamp_records
from ..sources.tables import COMMITS, TableStore
from .runlog import RunLog, append_failed_pages

log = logging.getLogger("pagelake.medallion")


@dataclass
class MedallionResult:
    params: RunParams
    store: TableStore
    bronze: DataFrame
    silver: DataFrame
    gold: DataFrame
    summary: DataFrame
    field_names: list[str]
    counts: dict = field(default_factory=dict)
    seconds: dict = field(default_factory=dict)
    quarantined: int = 0  # pages that gave no records because of an error


PASSING = "zstd"  # compression of the tables that last as long as their run
EARLIER = "committed by an earlier try"


def _guard(runlog: RunLog, layer: str, fn, seconds: dict):
    """Run one layer; on failure write the log (with a ``failed`` row), then re-raise."""
    try:
        t0 = time.time()
        out = fn()
        seconds[layer] = round(seconds.get(layer, 0) + time.time() - t0, 3)
        return out
    except Exception as exc:  # noqa: BLE001 - logged and re-raised
        runlog.failed(layer, f"{type(exc).__name__}: {exc}")
        raise


GOLD_FORMS = ("wide", "map", "long_tail")
HEAD_COLUMNS = 100  # columns of the long_tail form


def run_mode(table_key: str, load_mode: str) -> str:
    """Write mode of a run: what it would append replaces an earlier try of the same run."""
    mode = mode_for(table_key, load_mode)
    return "replace_run" if mode == "append" else mode


def gold_schema(names: list[str], rest: bool = False) -> StructType:
    """Schema of a run's wide gold table: keys, one string per field, with ``rest`` the map of the others, stamp."""
    key_types = {f.name: f.dataType for f in BRONZE_SCHEMA.fields}
    return StructType(
        [StructField(k, key_types[k], True) for k in GOLD_KEYS]
        + [StructField(c, StringType(), True) for _, c in column_plan(names)]
        + ([StructField(GOLD_MAP, PAYLOAD_MAP, True)] if rest else [])
        + [StructField(GOLD_STAMP, TimestampType(), True)])


def run_medallion(spark: SparkSession, pages: DataFrame, params: RunParams, store: TableStore,
                  in_row_gold: bool = True, records: DataFrame | None = None,
                  gold_form: str = "wide", parse_tasks: int | None = None, max_page_chars: int | None = None,
                  unique_pages: bool = False, head_columns: int = HEAD_COLUMNS, resume: bool = False) -> MedallionResult:
    """Run all layers for ``pages`` (``page_id, url, html``).

    Pages are parsed once, into a scrape table of the run: records and, for pages that can't be parsed (no HTML,
    longer than ``max_page_chars``, beyond the parser), errors.  Records go on to bronze; errors go to the quarantine table, and each
    of these pages gets a ``failed`` row in the run log under its url.  The others' run goes on.  The scrape table goes once both are written.

    Pages whose (page_id, url) occurs more than once are told apart (``distinct_pages``), unless
    ``unique_pages`` says that there are none.

    ``gold_form``: ``wide`` (one column per field name; raises above
    ``spark.sql.pivotMaxValues`` names), ``map`` (one map column, no limit) or ``long_tail`` (columns for the
    ``head_columns`` commonest names, a map for the others, no limit; needs ``in_row_gold``).
    Appending runs replace their own rows, so a retry leaves one copy.

    ``resume``: begin at the first layer that an earlier, failed try of this run has not committed.  The input must be that
    try's.  Markers made with other parameters (ids, time, environment, load mode) are ignored; a run that reaches
    its end leaves none, so running it again does everything again.

    ``in_row_gold`` derives gold and the summary from the rows of the run's fields table, whose record ids must be unique;
    ``False`` derives both from silver.  ``parse_tasks``: see ``extract_raw``.

    ``records`` may be given instead of pages (e.g. from
    ``payload_records``) to run the same layers over any payload table.
    """
    if gold_form not in GOLD_FORMS:
        raise ValueError(f"gold_form must be one of {GOLD_FORMS}, got {gold_form!r}")
    if gold_form == "long_tail" and not in_row_gold:
        raise ValueError("the long_tail form is built from the rows of the fields table: in_row_gold must be true")
    t = params.tables
    counts: dict[str, int] = {}
    seconds: dict[str, float] = {}
    runlog = RunLog(store, params)
    same_run = {"batch_id": params.batch_id, "run_timestamp": params.run_timestamp, "environment": params.environment, "load_mode": params.load_mode}
    done = {k: v for k, v in store.committed_layers(params.run_id).items() if v["run"] == same_run} if resume else {}
    if not done:
        store.drop_run(COMMITS, params.run_id)

    def layer(name: str, fn, part: str | None = None):
        """The rows that ``fn`` writes, or wrote in an earlier try (``part``: the step of the layer with a marker of its own)."""
        step = part or name
        if step in done:
            n = done[step]["rows"]
            if part is None and name != "scrape":
                runlog.success(name, n, EARLIER)
            return n
        n = _guard(runlog, name, fn, seconds)
        store.commit_layer(params.run_id, step, {"rows": n, "run": same_run})
        if part is None and name != "scrape":
            runlog.success(name, n)
        return n

    n_bad = 0
    if records is None:
        def scrape():
            src = pages if unique_pages else distinct_pages(pages)
            tagged = extract_tagged(src, tasks=parse_tasks, max_chars=max_page_chars)
            bad = Observation("quarantined")
            store.write(tagged.observe(bad, F.count_if(F.col("error").isNotNull()).alias("n")), t.extracts, "replace_run", run_id=params.run_id, codec=PASSING)
            return int(bad.get.get("n") or 0)

        n_bad = layer("scrape", scrape)

    def scraped():
        return store.read(t.extracts, run_id=params.run_id, columns=column_names(TAGGED_SCHEMA), schema=TAGGED_SCHEMA)

    def bronze_layer():
        recs = stamp_records(records_only(scraped()), params) if records is None else records
        n = store.write(to_bronze(recs, params), t.bronze, run_mode("bronze", params.load_mode), run_id=params.run_id)
        if n_bad:
            bad = quarantined(scraped(), params)
            store.write(bad, t.quarantine, "replace_run", run_id=params.run_id)
            append_failed_pages(store, params, bad)
        return n

    counts["bronze"] = layer("bronze", bronze_layer)
    if records is None:  # only once the marker stands: a try that resumes must find one of the two
        store.drop_run(t.extracts, params.run_id)
    if counts["bronze"] == 0:
        log.warning("no records extracted for run %s", params.run_id)
    bronze = store.read(t.bronze, run_id=params.run_id, columns=BRONZE_COLUMNS, schema=BRONZE_SCHEMA)

    def fields_step():
        return store.write(record_fields(bronze), t.fields, "replace_run", run_id=params.run_id, codec=PASSING)

    def silver_layer():
        return store.write(silver_of_fields(fields(), params), t.silver, run_mode("silver", params.load_mode),
                           run_id=params.run_id)

    def fields():
        return store.read(t.fields, run_id=params.run_id, columns=column_names(FIELDS_SCHEMA), schema=FIELDS_SCHEMA)

    layer("silver", fields_step, part="fields")
    counts["silver"] = layer("silver", silver_layer)
    silver = store.read(t.silver, run_id=params.run_id, columns=SILVER_COLUMNS, schema=SILVER_SCHEMA)

    def gold_layer():
        names = {"wide": lambda: field_names(silver), "map": list, "long_tail": lambda: head_names(fields(), head_columns)}[gold_form]()
        if gold_form == "long_tail":
            wide = curated_long_tail(fields(), params, names)
        elif gold_form == "map":
            wide = curated_map_of_fields(fields(), params) if in_row_gold else curated_map(silver, params)
        elif in_row_gold:
            wide = curated_wide_of_fields(fields(), params, names)
        else:
            wide = curated_wide(silver, params, names)
        n_gold = store.write(wide, t.gold, run_mode("gold", params.load_mode), run_id=params.run_id, lookup="source_url")
        sources = pages.select(F.col("url").alias("source_url")) if records is None else None
        summ = run_summary_of_fields(fields(), params, sources) if in_row_gold else run_summary(silver, params, sources)
        store.write(summ, t.gold_summary, run_mode("gold_summary", params.load_mode), run_id=params.run_id)
        return names, n_gold

    names, counts["gold"] = _guard(runlog, "gold", gold_layer, seconds)
    runlog.success("gold", counts["gold"])
    runlog.flush()
    store.drop_run(COMMITS, params.run_id)
    store.drop_run(t.fields, params.run_id)
    # one run's partition has one, known schema: no inference or merge job
    schema = gold_schema(names, rest=gold_form != "wide")
    gold = store.read(t.gold, run_id=params.run_id, columns=column_names(schema), schema=schema)
    summary = store.read(t.gold_summary, run_id=params.run_id, columns=column_names(SUMMARY_SCHEMA),
                         schema=SUMMARY_SCHEMA)
    return MedallionResult(params, store, bronze, silver, gold, summary, names, counts, seconds, n_bad)
