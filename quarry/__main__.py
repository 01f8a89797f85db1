"""Run a registered query: ``python -m quarry NAME [--tables DIR] [--output PATH]``.

Without ``--output`` the result is printed; with it, the result is written as
Parquet (or as text lines for results with a ``line`` column).
"""

from __future__ import annotations

import argparse

from .plans.catalog import QUERIES
from .session import kept_tables, local_session


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="quarry", description=__doc__)
    parser.add_argument("query", choices=sorted(QUERIES))
    parser.add_argument("--tables", required=True, help="folder of <table>.parquet files")
    parser.add_argument("--output", help="where to write the result")
    parser.add_argument("--local", default="*", help="local cores when no cluster session exists")
    args = parser.parse_args(argv)

    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession() or local_session(args.local)
    with kept_tables(spark):
        result = QUERIES[args.query](spark, args.tables)
        if not args.output:
            ordered = result.orderBy("line_no") if "line_no" in result.columns else result
            ordered.show(100, truncate=False)
        elif "line" in result.columns and "line_no" in result.columns:
            from .operators.report import write_text
            write_text(result, args.output)
        else:
            result.write.mode("overwrite").parquet(args.output)


if __name__ == "__main__":
    main()
