"""``python -m tielens PASS --data DIR [--live --out DIR] [--limit N] [--today D]``: dry by default, prints what it would write."""

from __future__ import annotations

import argparse
import dataclasses

from pyspark.sql import SparkSession

from .params import PARAMS
from .plans import reports
from .plans.passes import NIGHTLY, PASSES
from .sources.views import Tables


def main() -> None:
    parser = argparse.ArgumentParser(prog="tielens")
    parser.add_argument("name", choices=[*PASSES, "nightly"])
    parser.add_argument("--data", required=True)
    parser.add_argument("--out")
    parser.add_argument("--live", action="store_true")
    parser.add_argument("--limit", type=int, default=20)
    parser.add_argument("--today", default=PARAMS.today)
    parser.add_argument("--command-text")
    args = parser.parse_args()
    if args.live and not args.out:
        parser.error("--live needs --out")
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    params = dataclasses.replace(PARAMS, today=args.today, dry_run=not args.live)
    tables = Tables(spark, args.data)
    for name in NIGHTLY if args.name == "nightly" else [args.name]:
        more = {"text": args.command_text} if name == "part-d" and args.command_text else {}
        for part, df in PASSES[name](tables, params, **more).items():
            if args.live:
                df.write.mode("overwrite").parquet(f"{args.out}/{name}/{part}")
            print(f"== {name} {part}\n{reports.table(df, args.limit)}\n")


if __name__ == "__main__":
    main()
