"""spark-submit entry point: `python -m playlake INPUT_BASE OUTPUT_BASE`."""

import argparse

from playlake.plans.job import JobFailed, run
from playlake.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="playlake", description=__doc__)
    parser.add_argument("input_base", help="folder that holds song_data/ and log_data/")
    parser.add_argument("output_base", help="folder for tables and reports")
    parser.add_argument("--count-malformed-log", action="store_true", help="count unreadable log lines")
    args = parser.parse_args()
    spark = build_session()
    try:
        result = run(spark, args.input_base, args.output_base, args.count_malformed_log)
    except JobFailed as failure:
        report(failure.result)
        raise SystemExit(1) from failure
    report(result)


def report(result) -> None:
    for name, n in result.inputs.items():
        print(f"input   {name:22} {n}")
    for outcome in result.outcomes.values():
        print(f"output  {outcome.output:22} {outcome.error or outcome.rows}  {outcome.path}")


if __name__ == "__main__":
    main()
