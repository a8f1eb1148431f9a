"""Run the pricing batch: ``spark-submit -m roomrate`` or ``python -m roomrate``.

    python -m roomrate --catalog warehouse --ensemble s3://…/ensemble \\
        --out s3://…/pricing --as-of 2024-01-30

Inputs come from a metastore database (``--catalog``), from one Parquet folder
per table (``--parquet``) or, for a local try-out, from the driver test data
(``--driver-sf``). Cluster settings come from ``spark-submit``; the session is
taken as configured (``spark.checkpoint.dir`` must name shared storage on a
cluster).
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from roomrate.plans.pipeline import Models, price_all
from roomrate.session import REQUIRED_CONF
from roomrate.sources.contract import violations
from roomrate.sources.ensemble import CRAWL_MODEL, OWN_MODEL, ROOM_MODEL, demo_model, read_ensemble
from roomrate.sources.tables import RENTAL_TABLES, RentalTables


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="roomrate", description=__doc__.splitlines()[0])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--catalog", help="metastore database holding the input tables")
    src.add_argument("--parquet", help="root folder with one Parquet folder per input table")
    src.add_argument("--driver-sf", help="driver test data folder (fixture views)")
    p.add_argument("--ensemble", help="node table of the three models (Parquet); this or --booster is required but with --driver-sf")
    p.add_argument("--booster", nargs=3, metavar=("OWN", "CRAWL", "ROOM"), help="the three models as JSON files")
    p.add_argument("--any-case", action="store_true", help="match letters of room codes and shape notes in either case")
    p.add_argument("--audit", action="store_true", help="first print what the load replaces, per table, column and rule")
    p.add_argument("--out", required=True, help="output root for the dated CSV folders")
    p.add_argument("--as-of", type=dt.date.fromisoformat, required=True, help="run date (YYYY-MM-DD)")
    p.add_argument("--crawl-as-of", type=dt.date.fromisoformat, default=None, help="crawl run date (default: --as-of)")
    args = p.parse_args(argv)
    if not args.ensemble and not args.booster and not args.driver_sf:
        p.error("--ensemble or --booster is required: the demo models price driver test data only")

    spark = SparkSession.builder.appName("roomrate").getOrCreate()
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    if args.catalog:
        tables = RentalTables.from_catalog(spark, args.catalog)
    elif args.parquet:
        tables = RentalTables.from_parquet(spark, args.parquet)
    else:
        tables = RentalTables.from_driver(spark, args.driver_sf)
    if args.audit:
        for name in RENTAL_TABLES if not args.driver_sf else ():
            raw = spark.table(f"{args.catalog}.{name}") if args.catalog else spark.read.parquet(f"{args.parquet}/{name}")
            for row in violations(raw, name).where("rows > 0").collect():  # at most two rules a column
                print(f"{row['table']}.{row['column']}: {row['rows']} {row['rule']}")
    if args.booster:
        models = Models.from_boosters(spark, *args.booster)
    elif args.ensemble:
        models = Models.from_table(read_ensemble(spark, args.ensemble))
    else:
        models = Models(demo_model(OWN_MODEL), demo_model(CRAWL_MODEL), demo_model(ROOM_MODEL))
    out = price_all(tables, models, args.out, as_of=args.as_of, crawl_as_of=args.crawl_as_of or args.as_of, any_case=args.any_case)
    for name, path in out.paths.items():
        print(f"{name}: {path}")


if __name__ == "__main__":
    main()
