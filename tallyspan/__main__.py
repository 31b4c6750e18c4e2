"""``spark-submit -m`` entry: build, test, export or audit a warehouse."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tallyspan import fixed_values as fv
from tallyspan import jobs
from tallyspan.plans import ingest
from tallyspan.sources.wide_csv import registry


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallyspan")
    commands = parser.add_subparsers(dest="command", required=True)
    build = commands.add_parser("build", help="raw extracts to stored models")
    build.add_argument("--raw", required=True)
    build.add_argument("--out", required=True)
    build.add_argument("--prefix", default=fv.DEFAULT_GEO_PREFIX)
    build.add_argument("--all-regions", action="store_true", help="marts over every geography")
    build.add_argument("--years", nargs=2, type=int, default=[fv.FIRST_YEAR, fv.LAST_YEAR], metavar=("FIRST", "LAST"))
    build.add_argument("--ids", type=int, nargs="*", default=fv.STAGED_DATASETS)
    build.add_argument("--changed", action="store_true", help="only what changed since the last such build")
    test = commands.add_parser("test", help="declared data tests")
    test.add_argument("--out", required=True)
    export = commands.add_parser("export", help="marts to CSV")
    export.add_argument("--out", required=True)
    export.add_argument("--csv", required=True)
    audit = commands.add_parser("audit", help="landed files against the manifest")
    audit.add_argument("--manifest", required=True)
    audit.add_argument("--raw", required=True)
    audit.add_argument("--records", required=True)
    changes = commands.add_parser("changes", help="files that changed between the last two audits")
    changes.add_argument("--records", required=True)
    stale = commands.add_parser("stale", help="files of the last audit that are too old")
    stale.add_argument("--records", required=True)
    stale.add_argument("--days", type=int, required=True)
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("tallyspan").getOrCreate()
    if args.command == "build":
        sources, years = registry(args.raw, args.ids), [str(y) for y in range(args.years[0], args.years[1] + 1)]
        prefix = None if args.all_regions else args.prefix
        if args.changed:
            print("written:", *jobs.refresh_warehouse(spark, sources, args.out, prefix, years=years)[0])
        else:
            jobs.build_warehouse(spark, sources, args.out, prefix, years)
        if unread := ingest.unread_years(spark, sources, years):
            print("year columns not read:", *unread)
    elif args.command == "test":
        jobs.test_stored(spark, args.out).orderBy("passed", "table_name").show(100, False)
    elif args.command == "export":
        jobs.load_warehouse(spark, args.out)
        jobs.export_marts(spark, args.csv).show(truncate=False)
    elif args.command == "changes":
        jobs.landing_changes(spark, args.records).orderBy("status", "path").show(1000, False)
    elif args.command == "stale":
        jobs.stale_files(spark, args.records, args.days).orderBy("path").show(1000, False)
    else:
        jobs.audit_landing(spark, args.manifest, args.raw, args.records).show()


if __name__ == "__main__":
    main()
