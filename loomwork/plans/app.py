"""Command line: ``python -m loomwork.plans.app customers transactions out``."""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timezone

from loomwork.plans.audit import Audit
from loomwork.plans.batch import BatchSpec, csv_inputs, publish, run
from loomwork.session import build_session, scratch
from loomwork.sources.sinks import SinkSpec


def default_sinks(out: str) -> dict[str, SinkSpec]:
    return {
        "profile_sample": SinkSpec("csv", f"{out}/sample", mode="overwrite"),
        "denormalised": SinkSpec("json", f"{out}/denormalised", mode="overwrite"),
        "customers": SinkSpec(
            "parquet",
            f"{out}/customers",
            mode="overwrite",
            partition_by=["custprofession"],
        ),
        "masked": SinkSpec("csv", f"{out}/masked", mode="overwrite"),
        "age_metrics": SinkSpec("parquet", f"{out}/age_metrics", mode="overwrite"),
    }


def configured_sinks(path: str) -> dict[str, SinkSpec]:
    """Sinks from a JSON file: frame name to the fields of ``SinkSpec``.

    A ``table`` publishes to the catalog; format ``jdbc`` with its options
    publishes to a database.
    """
    with open(path, encoding="utf-8") as file:
        return {name: SinkSpec(**fields) for name, fields in json.load(file).items()}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Run the retail batch job.")
    parser.add_argument("customers", help="customer CSV path")
    parser.add_argument("transactions", help="transaction CSV path")
    parser.add_argument("out", help="folder to publish into")
    parser.add_argument("--sep", default=",")
    parser.add_argument("--sinks", default=None, help="JSON file of sinks that add to or replace the default ones")
    parser.add_argument("--run-ts", default=None, help="run timestamp, now by default")
    args = parser.parse_args(argv)

    spark = build_session("retail batch")
    run_ts = args.run_ts or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    customers, transactions = csv_inputs(args.customers, args.transactions, args.sep)
    sinks = default_sinks(args.out)
    if args.sinks:
        sinks |= configured_sinks(args.sinks)
    with scratch(spark):
        frames = run(spark, BatchSpec(customers, transactions, run_ts))
        publish(frames, sinks, Audit(spark, f"{args.out}/audit"))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
