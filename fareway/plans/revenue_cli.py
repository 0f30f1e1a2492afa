"""spark-submit entry point of the hourly revenue report.

    spark-submit fareway/plans/revenue_cli.py --input_green 'data/pq/green/*/*' \
        --input_yellow 'data/pq/yellow/*/*' --lookup data/zones --output data/report \
        [--since 2019-01-01] [--files 1]

Reads the two services (parquet globs), the zone lookup CSV (header, all
text), writes green, yellow, total (full outer join) and zones reports.
"""

from __future__ import annotations

import argparse
import json
import time

from fareway.plans.jobs import revenue_job
from fareway.session import get_session
from fareway.sources.files import read_lookup, read_trips


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--input_green", required=True)
    ap.add_argument("--input_yellow", required=True)
    ap.add_argument("--lookup", required=True, help="folder or file of the zone lookup CSV")
    ap.add_argument("--output", required=True)
    ap.add_argument("--since", default=None, help="lower bound on pickup time")
    ap.add_argument("--files", type=int, default=None, help="files per report (default: Spark decides)")
    args = ap.parse_args(argv)

    start = time.perf_counter()
    spark = get_session("revenue")
    try:
        out = revenue_job(spark, read_trips(spark, args.input_green), read_trips(spark, args.input_yellow),
                          read_lookup(spark, args.lookup), args.output, since=args.since, files=args.files)
    finally:
        spark.stop()
    print(json.dumps({"outputs": out, "seconds": round(time.perf_counter() - start, 2)}))
    return out


if __name__ == "__main__":
    main()
