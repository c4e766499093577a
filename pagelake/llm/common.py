"""Small helpers shared by the operators of this subpackage.

Word and letter rules, fresh column names, lineage cuts in the shared
folder, size-checked broadcasts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package, shared_root

#: a word: a run of anything but space, tab, newline, vertical tab, form feed, carriage return
WORD = r"[^\x20\x09-\x0D]+"

#: bytes with A-Z in lower case
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

#: a table is broadcast only if its measured bytes stay below this
BROADCAST_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """Each name, with underscores put before it until no column has it."""
    used = {c.lower() for c in taken}
    out = []
    for n in names:
        while n.lower() in used:
            n = "_" + n
        used.add(n.lower())
        out.append(n)
    return out


def cut(df: DataFrame) -> DataFrame:
    """Evaluate once and cut the lineage: a reliable checkpoint in the shared folder."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (already cut) marked for broadcast if its measured size is below ``limit`` bytes.

    Beyond the bound it is returned as it is: the join then shuffles.
    """
    size = {"string": F.octet_length, "binary": F.octet_length, "array<bigint>": lambda c: 8 * F.size(c)}
    width = sum((F.coalesce(size[t](F.col(f"`{c}`")), F.lit(0)) if t in size else F.lit(0)) for c, t in df.dtypes) + F.lit(16 * (len(df.columns) + 1))
    total = df.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(df) if total <= limit else df


def word_count(text: Column) -> Column:
    """Words of a text, null as the empty text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def uniform(*cols: Column) -> Column:
    """A number in [0, 1) fixed by the values of ``cols``."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) * F.lit(2.0**-53)


def id_text(c: Column) -> Column:
    """The id as text, null as the empty text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def id_crc(c: Column, modulus: int) -> Column:
    """crc32 of the id's text, by ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.encode(id_text(c), "utf-8")) % modulus


def prepare(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers."""
    ship_package(spark)


def map_rows(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` after shipping the package; ``fn`` maps an iterator of record batches."""
    prepare(df.sparkSession)
    return df.mapInArrow(fn, schema)


def slices(batches: Iterator, rows: int) -> Iterator:
    """The record batches in slices of at most ``rows`` rows, so that a task holds few texts at once."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)
