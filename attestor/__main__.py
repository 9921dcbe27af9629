"""Command line: run registered queries over a folder of tables.

    python -m attestor QUERY... --tables FOLDER [--out FOLDER] [--limit N] [--where SQL] [--fail-on-rows]

Exit code: 0 if all ran, 1 if --fail-on-rows is set and a query, such as one of violations, has rows, 2 for bad usage.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    from attestor.plans.catalogue import QUERIES

    parser = argparse.ArgumentParser(prog="attestor")
    parser.add_argument("queries", nargs="*", help="names of queries; none lists them")
    parser.add_argument("--tables", help="folder of the tables")
    parser.add_argument("--out", help="write each result as Parquet below this folder, in place of showing it")
    parser.add_argument("--limit", type=int, default=20, help="rows shown")
    parser.add_argument("--where", help="filter of the results")
    parser.add_argument("--fail-on-rows", action="store_true", help="rows are violations: exit with 1 if there are any")
    args = parser.parse_args(argv)
    if not args.queries:
        print("\n".join(sorted(QUERIES)))
        return 0
    unknown = [q for q in args.queries if q not in QUERIES]
    if unknown or not args.tables:
        print(f"unknown queries: {unknown}" if unknown else "--tables is missing", file=sys.stderr)
        return 2
    spark = spark or SparkSession.builder.getOrCreate()
    found = False
    for name in args.queries:
        df = QUERIES[name](spark, args.tables)
        df = df.where(args.where) if args.where else df
        if args.out:
            df.write.mode("overwrite").parquet(f"{args.out}/{name}")
            df = spark.read.parquet(f"{args.out}/{name}")
        else:
            df.show(args.limit, truncate=False)
        found |= args.fail_on_rows and not df.isEmpty()
    return int(found)


if __name__ == "__main__":
    sys.exit(main())
