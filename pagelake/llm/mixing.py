"""Mixing sources to target weights by pivotal dependent rounding. DataFrame functions only.

A source with target t and size s wants every document t/s times: the
whole part for sure, the fraction by rounding.  Rounding is dependent: two
documents exchange mass, measured in words, until one of the two
fractions is 0 or 1; which way the mass goes is drawn so that both
expectations stay.  The words of a source therefore stay at its target
through every duel.  Duels run in buckets of about ``fan`` documents; the
one open document of each bucket goes on to the next level of the tree, so
a level shuffles 1/fan of the rows of the one before, and no group is ever
larger than a bucket, however large a source is.

Defined cases: a null text has size 0; a null source is a source, last in
order; a document of size 0 takes the whole part and a coin for the
fraction; a source of size 0 has target 0; rows equal in source, id and
text are one entry with a count (their copies differ by at most one); an
empty table gives an empty result.  Draws come from hashes of seed, id and
text: the same rows give the same mix in any partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, fresh, uniform, word_count

CAP = 3.0  # no document is taken more often
FAN = 64  # documents that duel in one bucket
EPS = 1e-9


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: float = CAP) -> DataFrame:
    """(source, source_size, target) of a (source, size) table.

    Sources in code point order, nulls last, weigh ``weights`` in turn and
    share the total size; a target stops at ``cap`` times its source, the
    excess is shared by weight among the rest.  One row per source: the
    running sums below are over sources, never over documents.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    src = (by_source.withColumn("rank", rank)
           .withColumn("weight", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
           .withColumn("limit", F.lit(float(cap)) * F.col("source_size"))
           .withColumn("full_at", F.col("limit") / F.col("weight")))
    order = Window.orderBy("full_at", "rank")
    every = Window.partitionBy()
    # the water level if every source that fills up earlier is full; the true level is the highest of these
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    src = src.withColumn("level", (F.sum("source_size").over(every) - before) / rest)
    level = F.max("level").over(every)
    return src.select("source", "source_size", F.least("limit", level * F.col("weight")).alias("target"))


def _duel(acc: Column, y: Column) -> Column:
    """One exchange between the open document ``acc.open`` and ``y``; the settled one goes to ``acc.out``."""
    a, b, p, q = acc["open"]["size"], y["size"], acc["open"]["x"], y["x"]
    up = F.least(a * (F.lit(1.0) - p), b * q)  # words that can go from y to the open one
    down = F.least(a * p, b * (F.lit(1.0) - q))
    sign = F.when(uniform(acc["open"]["h"], y["h"]) * (up + down) < down, up).otherwise(-down)
    x, z = p + sign / a, q - sign / b
    settled = (x <= EPS) | (x >= 1 - EPS)
    mine, other = acc["open"].withField("x", x), y.withField("x", z)
    return (F.when((p <= EPS) | (p >= 1 - EPS), F.struct(y.alias("open"), F.concat(acc["out"], F.array(acc["open"])).alias("out")))
            .when(settled, F.struct(other.alias("open"), F.concat(acc["out"], F.array(mine)).alias("out")))
            .otherwise(F.struct(mine.alias("open"), F.concat(acc["out"], F.array(other)).alias("out"))))


def _settle(acc: Column, y: Column) -> Column:
    """Flip a decision of a source's last bucket if that brings its source nearer to the target."""
    step = F.when(y["x"] > 0.5, -y["size"]).otherwise(y["size"])
    flip = F.abs(acc["err"] + step) < F.abs(acc["err"])
    return F.struct(F.when(flip, acc["err"] + step).otherwise(acc["err"]).alias("err"),
                    F.concat(acc["out"], F.array(y.withField("x", F.when(flip, F.lit(1.0) - y["x"]).otherwise(y["x"])))).alias("out"))


ENTRY = ["size", "h", "doc_id", "th", "n", "base", "sure", "x"]


def decide(sized: DataFrame, targets: DataFrame, fan: int = FAN, seed: int = 1) -> DataFrame:
    """Copies for every entry of ``sized`` (source, doc_id, th, size; th is a hash of the text).

    Returns source, doc_id, th, size, n (rows of the entry), base and plus: ``plus`` of the n rows
    are taken base + 1 times, the others base times.
    """
    entries = sized.groupBy("source", "doc_id", "th", "size").agg(F.count(F.lit(1)).alias("n"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    entries = (entries.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
               .withColumn("base", F.floor(rate + EPS))
               .withColumn("mass", F.greatest(rate - F.col("base"), F.lit(0.0)) * F.col("n"))
               .withColumn("sure", F.floor(F.col("mass") + EPS))
               .withColumn("x", F.greatest(F.col("mass") - F.col("sure"), F.lit(0.0)))
               .withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "th")))
    entries = cut(entries.withColumn("x", F.when(F.col("size") > 0, F.col("x")).otherwise(
        (uniform(F.col("h")) < F.col("x")).cast("double"))).select("source", *ENTRY))
    open_ = (F.col("x") > EPS) & (F.col("x") < 1 - EPS)
    done = [entries.where(~open_)]
    counts = cut(entries.where(open_).groupBy("source").agg(F.count(F.lit(1)).alias("m")))
    most = counts.agg(F.max("m")).first()[0] or 0
    level = entries.where(open_).join(broadcast_if_small(counts.withColumnRenamed("source", "_s")),
                                      F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    depth = 0
    while most:
        buckets = F.ceil(F.col("m") / fan)
        groups = (level.withColumn("b", F.pmod(F.xxhash64("h", F.lit(depth)), buckets)).groupBy("source", "b")
                  .agg(F.sort_array(F.collect_list(F.struct(*ENTRY))).alias("e"), F.max(buckets).alias("m")))
        fold = F.aggregate(F.slice("e", 2, F.size("e")), F.struct(F.col("e")[0].alias("open"), F.filter("e", lambda _: F.lit(False)).alias("out")), _duel)
        groups = groups.select("source", "m", fold.alias("f"))
        left = F.col("f.open")
        near = F.round(left["x"])
        whole = F.concat("f.out", F.array(left.withField("x", near)))
        zero = F.struct((left["size"] * (near - left["x"])).alias("err"), F.filter("f.out", lambda _: F.lit(False)).alias("out"))
        settled = F.aggregate(F.reverse(F.array_sort(whole)), zero, _settle)["out"]
        # a source ends at the level where its rows fit one bucket, whatever other sources there are
        out = F.when(F.col("m") == 1, settled).otherwise(F.col("f.out"))
        groups = cut(groups.select("source", "m", left.alias("open"), out.alias("out")))
        done.append(groups.select("source", F.explode("out").alias("e")).select("source", "e.*"))
        if most <= fan:
            break
        rest = groups.where("m > 1").select("source", "m", "open.*")
        done.append(rest.where(~open_).select("source", *ENTRY))
        level, most, depth = rest.where(open_), -(-most // fan), depth + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("source", "doc_id", "th", "size", "n", "base", (F.col("sure") + F.round("x").cast("long")).alias("plus"))


def sized_rows(docs: DataFrame) -> DataFrame:
    return docs.select("source", "doc_id", F.xxhash64("text").alias("th"), word_count(F.col("text")).alias("size"))


def mixture(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: float = CAP, seed: int = 1) -> DataFrame:
    """One row per document: source, doc_id, size, source_size, target, copies. No text is shuffled."""
    sized = cut(sized_rows(docs))
    targets = broadcast_if_small(cut(source_targets(sized, weights, cap)))
    plan = decide(sized, targets, seed=seed)
    step = 1000  # rows of an entry per array
    plan = (plan.withColumn("lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(step).cast("long"))))
            .withColumn("i", F.explode(F.sequence("lo", F.least(F.col("lo") + step, F.col("n")) - 1))))
    copies = F.col("base") + (F.col("i") < F.col("plus")).cast("long")
    return (plan.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
            .select("source", "doc_id", "size", "source_size", "target", copies.alias("copies")))


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: float = CAP, seed: int = 1) -> DataFrame:
    """The mixed corpus: every document row as often as the mix takes it, with the columns of ``docs``.

    Equal rows of one entry get their numbers in two steps: counts by partition of a written table, then
    positions within a partition; so many equal rows don't meet in one task.
    """
    cols = docs.columns
    th, size, n, base, plus, part, before, pos, copy = fresh(cols, "th", "size", "n", "base", "plus", "part", "before", "pos", "copy")
    sized = cut(sized_rows(docs))
    plan = decide(sized, broadcast_if_small(cut(source_targets(sized, weights, cap))), seed=seed)
    plan = cut(plan.where((F.col("base") > 0) | (F.col("plus") > 0))).select(
        F.col("source").alias("_s"), F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("n").alias(n), F.col("base").alias(base), F.col("plus").alias(plus))
    keyed = docs.withColumn(th, F.xxhash64("text"))
    join = F.col("source").eqNullSafe(F.col("_s")) & F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col(th) == F.col("_t"))
    rows = keyed.join(plan, join).drop("_s", "_d", "_t")
    even = F.col(n) == 1
    single = rows.where(even).withColumn(copy, F.col(base) + F.col(plus))
    key = ["source", "doc_id", th]
    same = cut(rows.where(~even).withColumn(part, F.spark_partition_id()))
    per = same.groupBy(*key, part).agg(F.count(F.lit(1)).alias(pos))
    per = per.withColumn(before, F.coalesce(F.sum(pos).over(Window.partitionBy(*key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    per = per.select(F.col("source").alias("_s"), F.col("doc_id").alias("_d"), F.col(th).alias("_t"), F.col(part).alias("_p"), before)
    spot = F.row_number().over(Window.partitionBy(*key, part).orderBy(F.lit(0))) - 1
    same = (same.withColumn(pos, spot)
            .join(per, F.col("source").eqNullSafe(F.col("_s")) & F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col(th) == F.col("_t")) & (F.col(part) == F.col("_p")))
            .withColumn(copy, F.col(base) + ((F.col(pos) + F.col(before)) < F.col(plus)).cast("long")))
    out = single.select(*cols, copy).unionByName(same.select(*cols, copy)).where(F.col(copy) > 0)
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copy)))).select(*cols)


def query(docs: DataFrame) -> DataFrame:
    m = mixture(docs)
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")
