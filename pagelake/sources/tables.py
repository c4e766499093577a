"""Sinks and table reads for the layer tables.

Layer tables are parquet folders under one root (a shared location on a
cluster), partitioned by ``run_id``.  Modes:

* ``append``: rows are added.
* ``replace_run``: the run's partition folder is (re)written.  Other runs are
  untouched, and a retried run replaces its own earlier attempt instead of
  duplicating it, so a job that dies halfway can simply be run again.
* ``overwrite``: the whole table is replaced.
* ``errorifexists``: fail if the table exists.

Tables whose columns change between runs (gold) are read with
``mergeSchema``, which null-fills columns a run did not have.
"""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

log = logging.getLogger("pagelake.tables")

PARTITION_COLUMN = "run_id"
COMMITS = "_commits"  # markers of the layers that an unfinished run has written
MODES = ("append", "replace_run", "overwrite", "errorifexists")


def encode_complex(df: DataFrame) -> DataFrame:
    """Struct, array and map columns -> JSON text (null stays null), for
    sinks without nested types."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (StructType, ArrayType, MapType)):
            cols.append(F.to_json(F.col(f"`{f.name}`")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


@dataclass
class TableStore:
    """Parquet layer tables below ``root``."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def exists(self, name: str) -> bool:
        return _exists(self.spark, self.path(name))

    def write(self, df: DataFrame, name: str, mode: str = "append",
              run_id: str | None = None, lookup: str | None = None, codec: str | None = None) -> int:
        """Write ``df``; returns the number of rows written, measured by an
        ``Observation`` on the write itself (no second job).

        With ``run_id`` (all rows belong to that run) the rows go straight
        into the run's partition folder: no dynamic-partition machinery and
        no per-task sort on the partition column.  Without it the table is
        written partitioned by the ``run_id`` column of the rows.

        ``append`` adds rows.  ``replace_run`` replaces the rows of the runs
        it writes and keeps the others, so a retried run leaves one copy.

        ``lookup`` names a column that readers look single values up by: each file is sorted by it (no
        exchange) and carries a Bloom filter of it, so that ``column = value`` reads only the row groups, and of these the
        pages, that can hold the value.  ``codec``: compression of the files, else the session's.
        """
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
        obs = Observation(f"rows_{name}")
        observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        options = {} if codec is None else {"compression": codec}
        if lookup is not None:
            # a write by run sorts by the run first; asked for here, the order below it survives
            observed = observed.sortWithinPartitions(*([] if run_id is not None else [PARTITION_COLUMN]), lookup)
            # adaptive: the smallest filter that fits a row group's distinct values
            options |= {f"parquet.bloom.filter.enabled#{lookup}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
        if mode == "errorifexists" and self.exists(name):
            raise FileExistsError(f"table {self.path(name)} already exists")
        if run_id is not None:
            observed.drop(PARTITION_COLUMN).write.mode("append" if mode == "append" else "overwrite").format("parquet") \
                .options(**options).save(self.partition_path(name, run_id))
            if mode == "overwrite":
                # only after the new run is written: a failed write loses nothing
                self._delete_other_runs(name, run_id)
        else:
            w = observed.write.format("parquet").options(**options).partitionBy(PARTITION_COLUMN).mode("append" if mode == "append" else "overwrite")
            if mode == "replace_run":
                w = w.option("partitionOverwriteMode", "dynamic")
            w.save(self.path(name))
        rows = obs.get.get("rows", 0)
        log.info("wrote %d rows to %s (%s)", rows, self.path(name), mode)
        return int(rows)

    def _delete_other_runs(self, name: str, run_id: str) -> None:
        """Remove every partition folder of the table except ``run_id``'s
        (a metadata operation on the table folder, no data is read)."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path(name))
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        keep = self.partition_path(name, run_id).rsplit("/", 1)[1]
        for status in fs.listStatus(root):
            child = status.getPath()
            if child.getName().startswith(f"{PARTITION_COLUMN}=") and child.getName() != keep:
                fs.delete(child, True)

    def drop_run(self, name: str, run_id: str) -> None:
        """Remove one run's partition folder."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.partition_path(name, run_id))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def commit_layer(self, run_id: str, layer: str, facts: dict) -> None:
        """Mark a run's layer as written, with what a later try must know of it. The marker appears whole or not at all."""
        jvm = self.spark.sparkContext._jvm
        folder = self.partition_path(COMMITS, run_id)
        path, part = (jvm.org.apache.hadoop.fs.Path(f"{folder}/{f}") for f in (f"{layer}.json", f"_{layer}.tmp"))
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        out = fs.create(part, True)
        try:
            out.write(bytearray(json.dumps(facts).encode()))
        finally:
            out.close()
        fs.delete(path, False)
        if not fs.rename(part, path):
            raise OSError(f"could not write the marker {path}")

    def committed_layers(self, run_id: str) -> dict[str, dict]:
        """The markers of a run by layer."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.partition_path(COMMITS, run_id))
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return {}
        paths = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json")]
        found = {}
        for path in paths:
            stream = fs.open(path)
            try:
                text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            found[path.getName()[:-len(".json")]] = json.loads(text)
        return found

    def partition_path(self, name: str, run_id: str) -> str:
        esc = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog \
            .ExternalCatalogUtils.escapePathName(run_id)
        return f"{self.path(name)}/{PARTITION_COLUMN}={esc}"

    def read(self, name: str, run_id: str | None = None, where: str | None = None,
             columns: list[str] | None = None, merge_schema: bool = False,
             schema: StructType | None = None) -> DataFrame:
        """Read a table.  ``run_id`` reads only that run's partition folder
        (schema merging then touches only that run's files); ``where`` is
        pushed to the scan where it can be; ``columns`` fixes the order;
        a known ``schema`` (the layer contracts) skips schema inference,
        which would otherwise cost a job reading file footers.  Partition
        values stay strings (no type inference on run ids)."""
        def load(schema):
            reader = self.spark.read.option("mergeSchema", str(merge_schema).lower())
            reader = reader if schema is None else reader.schema(schema)
            if run_id is not None:
                return reader.option("basePath", self.path(name)).parquet(self.partition_path(name, run_id))
            return reader.parquet(self.path(name))

        if schema is None:  # read the files' schema, then type the partition column
            schema = StructType([StructField(f.name, StringType()) if f.name == PARTITION_COLUMN else f for f in load(None).schema])
        df = load(schema)
        if where:
            df = df.where(where)
        if columns:
            df = df.select(*[F.col(f"`{c}`") for c in columns])
        return df


def read_table(spark: SparkSession, path: str, where: str | None = None) -> DataFrame:
    """``SELECT * FROM t [WHERE ...]`` over a parquet table folder."""
    df = spark.read.parquet(path)
    return df.where(where) if where else df


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a catalog database if it is absent (idempotent)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def _ddl(field: StructField) -> str:
    return f"`{field.name.replace('`', '``')}` {field.dataType.simpleString()}"


def register_tables(spark: SparkSession, store: TableStore, database: str,
                    names: dict[str, str]) -> None:
    """Expose layer folders as catalog tables so BI SQL can query them by name.

    Call it after every run: a table gets the columns of all its runs.  The first call creates it with the merged schema of its
    files (``CREATE TABLE ... USING parquet LOCATION``); later calls compare that schema with the catalog's and add what is
    missing (``ALTER TABLE ... ADD COLUMNS``), which null-fills the runs without it.  A column whose type changed raises.
    """
    ensure_database(spark, database)
    for name in names.values():
        if not store.exists(name):
            continue
        full = f"`{database}`.`{name}`"
        fields = store.read(name, merge_schema=True).schema.fields
        parted = any(f.name == PARTITION_COLUMN for f in fields) and _partitioned(store, name)
        if not spark.catalog.tableExists(f"{database}.{name}"):
            by = f" PARTITIONED BY (`{PARTITION_COLUMN}`)" if parted else ""
            spark.sql(f"CREATE TABLE {full} ({', '.join(map(_ddl, fields))}) USING parquet{by} LOCATION '{store.path(name)}'")
        else:
            known = {f.name.lower(): f.dataType for f in spark.table(full).schema.fields}
            changed = [f.name for f in fields if known.get(f.name.lower(), f.dataType) != f.dataType]
            if changed:
                raise ValueError(f"table {full}: columns {changed} changed their type")
            new = [f for f in fields if f.name.lower() not in known]
            if new:
                spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({', '.join(map(_ddl, new))})")
        if parted:
            spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
        spark.sql(f"REFRESH TABLE {full}")


def _partitioned(store: TableStore, name: str) -> bool:
    """Does the table have run folders?"""
    root = store.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store.path(name))
    fs = root.getFileSystem(store.spark.sparkContext._jsc.hadoopConfiguration())
    return any(s.getPath().getName().startswith(f"{PARTITION_COLUMN}=") for s in fs.listStatus(root))


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 batchsize: int = 1000, driver: str | None = None) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "batchsize": str(batchsize)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    return opts


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **kw) -> None:
    """Distributed JDBC write: each task inserts its partition in batches.
    Needs the database's JDBC driver on the classpath."""
    encode_complex(df).write.format("jdbc").options(**jdbc_options(url, table, **kw)).mode(mode).save()

