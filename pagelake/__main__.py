"""Command line: ``python -m pagelake --pages PATH --lake PATH [options]``.

Runs all layers for a pages table (or a folder of HTML files) into the
layer tables under ``--lake`` and prints the gold preview and summary.
"""

from __future__ import annotations

import argparse
import sys

from .params import ENVIRONMENTS, LOAD_MODES, RunParams


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="pagelake", description=__doc__.splitlines()[0])
    ap.add_argument("--pages", required=True, help="pages parquet table or folder of .html files")
    ap.add_argument("--format", choices=("parquet", "html"), default="parquet")
    ap.add_argument("--lake", required=True, help="root folder of the layer tables (shared storage)")
    ap.add_argument("--environment", choices=ENVIRONMENTS, default="dev")
    ap.add_argument("--load-mode", choices=LOAD_MODES, default="append")
    ap.add_argument("--run-id", default=None)
    ap.add_argument("--relational-gold", action="store_true", help="gold by grouped pivot over silver")
    ap.add_argument("--gold-form", choices=("wide", "map", "long_tail"), default="wide", help="one column per field, a map, or columns for the commonest and a map")
    ap.add_argument("--head-columns", type=int, default=100, help="columns of the long_tail form")
    args = ap.parse_args(argv)

    from .operators import views as V
    from .plans.medallion import run_medallion
    from .session import get_spark
    from .sources.extract import read_pages
    from .sources.tables import TableStore

    spark = get_spark()
    kw = {"environment": args.environment, "load_mode": args.load_mode, "source_label": args.pages}
    if args.run_id:
        kw["run_id"] = args.run_id
    params = RunParams.new(**kw)
    res = run_medallion(spark, read_pages(spark, args.pages, args.format), params,
                        TableStore(spark, args.lake), in_row_gold=not args.relational_gold, gold_form=args.gold_form, head_columns=args.head_columns)
    print(f"run {params.run_id}: {res.counts}")
    V.console_preview(res.gold).show(truncate=60)
    V.summary_latest_first(res.summary).show(truncate=100)
    return 0


if __name__ == "__main__":
    sys.exit(main())
