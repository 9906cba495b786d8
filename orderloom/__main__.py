"""Run one batch: ``spark-submit`` or ``python -m orderloom --date D --warehouse W --landing L``."""

from __future__ import annotations

import argparse
import logging

from orderloom.plans.batch import Extras, publish_marts, run_batch, run_checks
from orderloom.plans.warehouse import Warehouse
from orderloom.session import release_scratch, spark_session

#: What a run may keep beside the star; later runs go on with it.
EXTRAS = {
    "history": "keep versions of customers and products",
    "compatibility": "keep the bridge of parts and vehicles",
    "kept_marts": "keep the marts as states that each run adds to",
    "replay_rejects": "store rows without customer, order or part and try them again",
    "cost_on_order_date": "margins at the cost of the order's day; keeps the history too",
}


def main() -> None:
    parser = argparse.ArgumentParser(prog="orderloom")
    parser.add_argument("--date", required=True, help="day whose delivery is loaded (ISO date)")
    parser.add_argument("--warehouse", required=True, help="root folder of the stored layers")
    parser.add_argument("--landing", required=True, help="folder holding <date>/*.csv")
    parser.add_argument("--init", action="store_true", help="create the layer folders first")
    parser.add_argument("--marts", metavar="FOLDER", help="also store each mart there as Parquet")
    parser.add_argument(
        "--multi-line", choices=["auto", "yes", "no"], default="auto",
        help="whether quoted values run over line ends; auto reads each delivery once more to see",
    )
    parser.add_argument("--checks", action="store_true", help="print the data-quality report after")
    parser.add_argument("--keep-runs", type=int, help="delete star folders of older runs after")
    parser.add_argument("--no-gate", action="store_true", help="publish without checking what the run wrote")
    for name, said in EXTRAS.items():
        parser.add_argument(f"--{name.replace('_', '-')}", action="store_true", help=said)
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s [%(levelname)s] %(name)s: %(message)s")

    spark = spark_session()
    warehouse = Warehouse(spark, args.warehouse)
    if args.init:
        warehouse.init()
    multi_line = {"auto": None, "yes": True, "no": False}[args.multi_line]
    extras = Extras(gate=not args.no_gate, **{name: getattr(args, name) for name in EXTRAS})
    run_batch(spark, args.warehouse, args.landing, args.date, multi_line=multi_line, extras=extras)
    if args.marts:
        publish_marts(warehouse, write_to=args.marts)
    if args.checks:
        run_checks(warehouse).show(truncate=False)
    if args.keep_runs:
        warehouse.expire(args.keep_runs)
    release_scratch(spark)


if __name__ == "__main__":
    main()
