"""``python -m tidegate``: one run over venues.csv into ./warehouse; 1 if the gate refuses it."""

from __future__ import annotations

import argparse
import sys

from tidegate.plans.engine import run
from tidegate.plans.warehouse import Warehouse
from tidegate.schema import QualityGateFailed
from tidegate.session import get_spark
from tidegate.sources.dimension import read_venues
from tidegate.sources.items import synthetic


def main(argv: list[str] | None = None) -> int:
    a = argparse.ArgumentParser(prog="tidegate", description=__doc__)
    a.add_argument("--venues", default="venues.csv")
    a.add_argument("--warehouse", default="warehouse")
    a.add_argument("--synthetic", action="store_true", help="generated counts instead of the API")
    args = a.parse_args(argv)
    venues = read_venues(args.venues)
    try:
        s = run(Warehouse(get_spark(), args.warehouse), venues, source=synthetic if args.synthetic else None)
    except QualityGateFailed as e:
        print(f"refused by the quality gate: {e}", file=sys.stderr)
        return 1
    print(f"run {s.run_id} {s.status}: {s.requests} requests, {s.rows_fetched} fetched, {s.rows_loaded} loaded, {s.rows_quarantined} quarantined ({s.reject_rate:.2%})")
    if s.note:
        print(s.note)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
