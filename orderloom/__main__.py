"""Run the whole preparation on files: ``spark-submit … -m orderloom`` or
``python -m orderloom --sales … --out …``."""

from __future__ import annotations

import argparse

from .operators.audit import log_summary
from .operators.typed import sales_constraints
from .plans.fixed_values import KEY_LENGTH
from .plans.prepare import MAPPING_COLUMNS, prepare, read_inputs, stage_counts
from .plans.stage_store import collected_stages, remove_stages
from .session import builder


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="orderloom", description=__doc__)
    parser.add_argument("--sales", required=True, help="landing text with a header")
    for name in MAPPING_COLUMNS:
        parser.add_argument("--" + name.replace("_", "-"), required=True)
    parser.add_argument("--out", required=True, help="folder of the results")
    parser.add_argument("--sales-sep", default=";")
    parser.add_argument("--mapping-sep", default=",")
    parser.add_argument("--run", help="name of this run's batch in the log, which it replaces; new by default")
    parser.add_argument("--backup", action="store_true", help="keep a copy of the typed table")
    parser.add_argument("--csv", action="store_true", help="export the results as CSV too")
    parser.add_argument(
        "--constraints", choices=["off", "quarantine", "abort"], default="quarantine",
        help="what to do with rows that break a constraint of the typed table",
    )
    parser.add_argument(
        "--key-length", type=int, default=KEY_LENGTH, help="characters of an order id"
    )
    given = parser.parse_args(arguments)

    spark = builder().getOrCreate()
    with collected_stages() as landed:
        inputs = read_inputs(
            spark, given.sales, given.sales_sep, given.mapping_sep,
            **{name: getattr(given, name) for name in MAPPING_COLUMNS},
        )
    done = prepare(
        inputs,
        given.out,
        constraints=None if given.constraints == "off" else sales_constraints(key_length=given.key_length),
        strict=given.constraints == "abort",
        csv=given.csv,
        backup=given.backup,
        run=given.run,
    )
    remove_stages(spark, landed)
    stage_counts(spark, done.counts).show(len(done.counts), truncate=False)
    log_summary(spark, f"{given.out}/audit_log").show(100, truncate=False)


if __name__ == "__main__":
    main()
