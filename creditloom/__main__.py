"""Command line: build the mart for a range of months from a folder of CSV files."""

from __future__ import annotations

import argparse

from creditloom.operators.encoding import MAX_VOCABULARY
from creditloom.operators.labels import DEFAULT_DPD, DEFAULT_MOB
from creditloom.plans.backfill import Mart, backfill
from creditloom.plans.publish import publish
from creditloom.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="creditloom", description=__doc__)
    parser.add_argument("--source", required=True, help="folder with the four CSV files")
    parser.add_argument("--root", required=True, help="folder of the mart")
    parser.add_argument("--start", required=True, help="first snapshot, yyyy-mm-dd")
    parser.add_argument("--end", required=True, help="last snapshot, yyyy-mm-dd")
    parser.add_argument("--dpd", type=int, default=DEFAULT_DPD)
    parser.add_argument("--mob", type=int, default=DEFAULT_MOB)
    parser.add_argument("--money", default="float", help="type of amounts, for example decimal(12,2)")
    parser.add_argument("--exclude", nargs="*", default=(), help="columns to keep out of the feature store")
    parser.add_argument("--max-vocabulary", type=int, default=MAX_VOCABULARY, help="values a vocabulary may have")
    parser.add_argument("--unique-customers", action="store_true", help="fail on repeated customers")
    parser.add_argument("--buckets", type=int, help="buckets by customer of the silver tables")
    parser.add_argument("--run", help="build in a run of this name and publish it as a whole, or resume it")
    parser.add_argument("--master", help="Spark master, when not set by spark-submit")
    options = vars(parser.parse_args())
    spark, run = build_session(master=options.pop("master")), options.pop("run")
    mart = Mart(**options)
    for table, audit in (publish(spark, mart, run) if run else backfill(spark, mart)).items():
        lost = f", {audit.rejected} rejected" if audit.rejected else ""
        print(f"{table}: {audit.rows} rows, {len(audit.snapshots)} snapshots{lost}")


if __name__ == "__main__":
    main()
