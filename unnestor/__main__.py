"""Command line: load document dumps into tables.

    spark-submit -m unnestor --schema-dir layouts/ \\
        --dump order=s3://dumps/order/ --dump user=s3://dumps/user/ \\
        --parquet s3://lake/tables --quarantine s3://lake/quarantine

Each ``--dump name=path`` is one database (names as in ``ENTITIES``, or bound
with ``--bind name=root_layout``). Prints one JSON line per loaded table.
The Spark session comes from the submitting environment (master, resources,
``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import json
import sys


def _pairs(values: list[str], what: str) -> dict[str, str]:
    out = {}
    for v in values or []:
        if "=" not in v:
            raise SystemExit(f"{what} must be name=value, got {v!r}")
        k, _, p = v.partition("=")
        out[k] = p
    return out


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="unnestor", description=__doc__.split("\n\n")[0])
    ap.add_argument("--schema-dir", required=True, help="folder of YAML layouts")
    ap.add_argument("--dump", action="append", required=True, help="database=path of its dump")
    ap.add_argument("--bind", action="append", default=[], help="database=root layout key")
    ap.add_argument("--layout", choices=["lines", "envelope"], default="lines")
    ap.add_argument("--parquet", help="root folder of the Parquet tables")
    ap.add_argument("--jdbc-url", help="JDBC URL of the target database")
    ap.add_argument("--jdbc-property", action="append", default=[], help="key=value (user, driver, ...)")
    ap.add_argument("--jdbc-partitions", type=int, default=None)
    ap.add_argument("--quarantine", help="Parquet folder for rows and documents set aside")
    ap.add_argument("--mode", choices=["strict", "permissive"], default="strict")
    ap.add_argument("--load", choices=["refresh", "upsert"], default="refresh")
    ap.add_argument("--order-by", help="column ordering versions of a row (upsert)")
    ap.add_argument("--no-dedupe", action="store_true", help="keys are unique; skip the dedupe shuffle")
    ap.add_argument("--buckets", type=int, default=None, help="lay Parquet tables out in so many key buckets, for upserts")
    ap.add_argument("--parallel", type=int, default=1, help="databases, and tables of each, that load at once")
    ap.add_argument("--keep-going", action="store_true", help="report a database that fails and load the others")
    ap.add_argument("--verify", choices=["rows", "content"], default="rows", help="what is compared after a load")
    ap.add_argument("--duplicates", choices=["error", "first", "last"], default="error",
                    help="repeated YAML keys: reject, or keep the first / last")
    args = ap.parse_args(argv)
    if bool(args.parquet) == bool(args.jdbc_url):
        ap.error("give exactly one of --parquet and --jdbc-url")

    from pyspark.sql import SparkSession

    from .plans.catalog import Catalog
    from .plans.pipeline import ENTITIES, run_databases
    from .sinks.tables import JdbcStore, ParquetStore

    spark = SparkSession.builder.appName("unnestor").getOrCreate()
    catalog = Catalog.load_dir(args.schema_dir, duplicates=args.duplicates)
    bindings = {**ENTITIES, **_pairs(args.bind, "--bind")}
    if args.parquet:
        store = ParquetStore(args.parquet, buckets=args.buckets)
    else:
        store = JdbcStore(args.jdbc_url, _pairs(args.jdbc_property, "--jdbc-property"),
                          num_partitions=args.jdbc_partitions)
    quarantine = ParquetStore(args.quarantine) if args.quarantine else None
    runs = run_databases(
        spark, _pairs(args.dump, "--dump"), catalog, store, bindings=bindings, layout=args.layout,
        mode=args.mode, load_mode=args.load, order_by=args.order_by, quarantine=quarantine,
        dedupe=not args.no_dedupe, parallel=args.parallel, on_error="report" if args.keep_going else "stop", verify=args.verify,
    )
    failed = False
    for run in runs:
        if run.error:
            failed = True
            print(json.dumps({"database": run.database, "status": run.status, "error": run.error}))
        for r in run.tables:
            # rows set aside with nowhere to keep them are lost
            failed |= r.status != "ok" or (r.rejected > 0 and quarantine is None)
            print(json.dumps({"database": run.database, "table": r.table, "written": r.written,
                              "loaded": r.loaded, "rejected": r.rejected, "status": r.status}))
        if run.rejected_documents:
            failed |= quarantine is None
            print(json.dumps({"database": run.database, "rejected_documents": run.rejected_documents}))
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
