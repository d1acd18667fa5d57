"""Run registered queries from the command line.

  python -m tessera list
  python -m tessera run <query> [sf_dir] [--rows N] [--explain]

``run`` shows the first N rows of the result (default 20) in the query's own
order; ``--explain`` prints the formatted physical plan instead.
"""

from __future__ import annotations

import argparse
import sys

from tessera.plans.catalog import QUERIES
from tessera.session import local_session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m tessera")
    sub = parser.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list the registered queries")
    run = sub.add_parser("run", help="run one registered query")
    run.add_argument("query", choices=sorted(QUERIES))
    run.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.01")
    run.add_argument("--rows", type=int, default=20)
    run.add_argument("--explain", action="store_true")
    args = parser.parse_args(argv)

    if args.cmd == "list":
        for name, fn in QUERIES.items():
            doc = (fn.__doc__ or "").strip().splitlines()
            print(f"{name:30s} {doc[0] if doc else ''}")
        return 0

    spark = local_session(app=f"tessera-{args.query}")
    df = QUERIES[args.query](spark, args.sf_dir)
    if args.explain:
        df.explain("formatted")
    else:
        df.show(args.rows, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
