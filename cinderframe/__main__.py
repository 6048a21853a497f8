"""python -m cinderframe queries | query NAME --data DIR --out DIR | fires GPKG --out DIR [filters]."""

from __future__ import annotations

import argparse
import sys

from cinderframe.operators import constants as C


def states(text: str) -> list[str]:
    found = [s.strip().upper() for s in text.split(",") if s.strip()]
    unknown = sorted(set(found) - {s for s, _, _ in C.SEASONS})
    if unknown:
        raise argparse.ArgumentTypeError(f"no season is known for {', '.join(unknown)}")
    return found


def year(text: str) -> int:
    y = int(text)
    if not C.YEARS[0] <= y <= C.YEARS[1]:
        raise argparse.ArgumentTypeError(f"{y} isn't within {C.YEARS[0]} and {C.YEARS[1]}")
    if y > C.YEARS[1] - 2:
        print(f"{y}: scenes of the years after it may be few", file=sys.stderr)
    return y


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cinderframe", description="Fire-severity analytics on Spark.")
    sub = top.add_subparsers(dest="command", required=True)
    sub.add_parser("queries", help="list the named queries")
    q = sub.add_parser("query", help="run a named query and write its result")
    q.add_argument("name")
    q.add_argument("--data", required=True, help="folder of the input tables")
    q.add_argument("--out", required=True)
    q.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    f = sub.add_parser("fires", help="select fires of a GeoPackage and write them")
    f.add_argument("path")
    f.add_argument("--out", required=True)
    f.add_argument("--layer")
    f.add_argument("--states", type=states)
    f.add_argument("--first", type=year, default=C.YEARS[0])
    f.add_argument("--last", type=year)
    f.add_argument("--exclude", help="text file of ids, one a line")
    f.add_argument("--limit", type=int)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    from cinderframe.plans import catalogue, extras  # noqa: F401

    if args.command == "queries":
        print("\n".join(sorted(catalogue.QUERIES)))
        return 0
    if args.command == "query" and args.name not in catalogue.QUERIES:
        print(f"no query is named {args.name}", file=sys.stderr)
        return 2
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    spark = SparkSession.builder.appName("cinderframe").getOrCreate()
    if args.command == "query":
        catalogue.QUERIES[args.name](spark, args.data).write.mode("overwrite").format(args.format).option("header", True).save(args.out)
        return 0
    from cinderframe.operators import catalog
    from cinderframe.sources import files, vector

    vector.register(spark)
    read = spark.read.format("gpkg")
    found = (read.option("layer", args.layer) if args.layer else read).load(args.path)
    found = found.withColumns({"event_id": F.col("Event_ID"), "incid_type": F.col("Incid_Type").cast("int"), "ig_date": F.to_date(F.col("Ig_Date").cast("string"))})
    found = catalog.select_fires(found, states=args.states, years=(args.first, args.last or C.YEARS[1]))
    if args.exclude:
        found = catalog.without(found, files.exclude_list(spark, args.exclude))
    found = found.select("event_id", "state", "year", "start_day", "end_day").orderBy("event_id")
    files.write_csv(found.limit(args.limit) if args.limit else found, args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
