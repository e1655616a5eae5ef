"""python -m strandline: run the site pipeline over a folder of Parquet tables."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import site
from .sources.tables import Settings

TABLES = ["scenes", "points", "transects", "tides"]


def main(argv: list[str] | None = None) -> None:
    names = [n for n, _ in site.STAGES]
    parser = argparse.ArgumentParser(prog="strandline", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("stages", help="list the stages")
    run = commands.add_parser("run", help="run all stages, or from one on")
    run.add_argument("tables", help=f"folder with {', '.join(TABLES)} as Parquet")
    run.add_argument("output", help="folder for the results, a folder a stage")
    run.add_argument("--site", required=True)
    run.add_argument("--epsg", type=int, required=True, help="code of the tables' coordinates")
    run.add_argument("--from", dest="first", choices=names)
    run.add_argument("--slope", type=float, default=0.1)
    run.add_argument("--reference", type=float, default=0.0)
    run.add_argument("--search-slopes", action="store_true", help="find each transect's slope instead of taking --slope")
    args = parser.parse_args(argv)
    if args.command == "stages":
        print("\n".join(names))
        return
    spark = SparkSession.builder.appName(f"strandline {args.site}").getOrCreate()
    frames = {t: spark.read.parquet(f"{args.tables}/{t}.parquet") for t in TABLES}
    site.run(spark, frames, Settings(sitename=args.site, output_epsg=args.epsg, beach_slope=args.slope, reference_elevation=args.reference, extra={"slope_search": args.search_slopes}), args.output, args.first)


if __name__ == "__main__":
    main()
