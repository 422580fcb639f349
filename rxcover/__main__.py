"""Command line: ``python -m rxcover build|reports ...``.

Uses the active session configuration (``spark-submit`` options or
``spark-defaults.conf``); ``--local`` starts a local session instead.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session(local: bool) -> SparkSession:
    if local:
        from rxcover.session import local_session

        return local_session()
    return SparkSession.builder.appName("rxcover").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="rxcover")
    p.add_argument("--local", action="store_true", help="run in a local session")
    sub = p.add_subparsers(dest="cmd", required=True)

    b = sub.add_parser("build", help="XML release -> record tables, spine, CSV, catalog tables")
    b.add_argument("--products", required=True, help="folder searched for product XML files")
    b.add_argument("--classifications", required=True, help="folder searched for classification XML files")
    b.add_argument("--out", required=True, help="output folder (shared)")
    b.add_argument("--row-tag", action="append", dest="row_tags", help="classification record tag (repeatable; default: any element with a key)")
    b.add_argument("--database", help="catalog database for the vmp, bnf and spine tables")
    b.add_argument("--fallback-unit-first", action="store_true")

    r = sub.add_parser("reports", help="spine table -> one table per report")
    r.add_argument("--spine", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--levels", type=int, default=4, choices=(3, 4))
    r.add_argument("--antibiotic", default="any", choices=("any", "atc"))

    a = p.parse_args(argv)
    spark = _session(a.local)
    if a.cmd == "build":
        from rxcover.build import run_build

        out = run_build(spark, a.products, a.classifications, a.out, row_tags=a.row_tags,
                        database=a.database, fallback_unit_first=a.fallback_unit_first)
        print(json.dumps(out.__dict__))
    else:
        from rxcover.build import run_reports

        print(json.dumps(run_reports(spark, a.spine, a.out, levels=a.levels, antibiotic=a.antibiotic)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
