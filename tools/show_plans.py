"""Print the physical plan tree and exchange count of each main operator.

Usage: python tools/show_plans.py [sf_dir] > PLANS.md
Bronze and silver are materialised into a scratch folder first so that the
later plans start from table scans, as they do inside ``run_medallion``.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tree(df) -> str:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return text.split("\n\n\n")[0].strip()


def main():
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from pagelake.operators import gold as G
    from pagelake.operators import views as V
    from pagelake.operators.bronze import to_bronze
    from pagelake.operators.silver import to_silver, to_silver_relational
    from pagelake.params import RunParams
    from pagelake.sources.extract import extract_records
    from pagelake.sources.tables import TableStore

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "16")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    p = RunParams.fixed()
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    store = TableStore(spark, tempfile.mkdtemp(prefix="plans-"))
    store.write(to_bronze(extract_records(pages, p), p), "bronze", run_id=p.run_id)
    bronze = store.read("bronze", run_id=p.run_id)
    store.write(to_silver(bronze, p), "silver", run_id=p.run_id)
    silver = store.read("silver", run_id=p.run_id)
    names = G.field_names(silver)
    store.write(G.curated_wide_in_row(bronze, p, names), "gold", run_id=p.run_id)
    gold = store.read("gold", merge_schema=True)
    plans = {
        "extract + bronze (pages -> bronze rows)": to_bronze(extract_records(pages, p), p),
        "silver, in-row (default)": to_silver(bronze, p),
        "silver, relational (cross-check)": to_silver_relational(bronze, p),
        "gold field names (distinct, bounded collect)": silver.filter(F.col("is_valid")).select("field_name")
        .distinct().orderBy("field_name").limit(10001),
        "gold wide, in-row (default)": G.curated_wide_in_row(bronze, p, names),
        "gold wide, grouped pivot over silver": G.curated_wide(silver, p, names),
        "gold wide, keys + pivot + left join (reference shape)": G.curated_wide_keys_join(silver, p, names),
        "run summary, in-row (default; pages as markers)": G.run_summary_in_row(
            bronze, p, sources=pages.select(F.col("url").alias("source_url"))),
        "run summary over silver (ids may repeat)": G.run_summary(
            silver, p, sources=pages.select(F.col("url").alias("source_url"))),
        "latest gold per source (aggregate + semi join)": V.latest_gold_per_url(gold),
        "gold preview (top 50)": V.gold_preview(gold),
    }
    print("# Physical plans\n")
    print(f"Generated by `python tools/show_plans.py {sf_dir}` (Spark {spark.version}, local[8], AQE on;")
    print("initial plans, AQE may still coalesce partitions or switch a join to broadcast at run time).")
    print("No join carries a hint for broadcast; the keys join is a merge join on the partitioning")
    print("its inputs already have.\n")
    notes = {
        "extract + bronze (pages -> bronze rows)":
            "Pages are parsed where they are read, unless the caller sets a number of parse tasks.",
        "gold field names (distinct, bounded collect)":
            "Partial aggregation before the exchange: only distinct names per task move.",
        "run summary, in-row (default; pages as markers)":
            "Every exchange follows a partial aggregate; no record id is exchanged.",
    }
    for title, df in plans.items():
        t = tree(df)
        n = len(re.findall(r"(?<![A-Za-z])Exchange \(", t))
        nb = len(re.findall(r"BroadcastExchange \(", t))
        note = f"{notes[title]}\n\n" if title in notes else ""
        print(f"## {title}\n\nshuffle exchanges: **{n}**, broadcast exchanges: {nb}\n\n{note}```\n{t}\n```\n")


if __name__ == "__main__":
    main()
