"""python -m tidemark list | run QUERY --data DIR [--out PATH] | explain QUERY --data DIR | append --batch PATH --log PATH [--tombstones PATH] | scan --data DIR --log PATH (--date DAY | --days N)"""

from __future__ import annotations

import argparse

from tidemark.session import get_spark


def _queries() -> dict:
    from tidemark.plans import registry

    return registry.QUERIES


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    p.add_argument("--master", default="local[*]")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list")
    for name in ("run", "explain"):
        q = sub.add_parser(name)
        q.add_argument("query")
        q.add_argument("--data", required=True)
        q.add_argument("--out")
    a = sub.add_parser("append")
    a.add_argument("--batch", required=True)
    a.add_argument("--log", required=True)
    a.add_argument("--tombstones")
    d = sub.add_parser("scan")
    d.add_argument("--data", required=True)
    d.add_argument("--log", required=True)
    when = d.add_mutually_exclusive_group(required=True)
    when.add_argument("--date")
    when.add_argument("--days", type=int)
    args = p.parse_args(argv)
    if args.command == "list":
        print("\n".join(sorted(_queries())))
        return 0
    spark = get_spark(args.master)
    if args.command == "append":
        from tidemark.sinks import append_events

        stones = spark.read.parquet(args.tombstones) if args.tombstones else None
        print(append_events(spark.read.parquet(args.batch), args.log, stones))
        return 0
    if args.command == "scan":
        from tidemark.plans.daily import scan_days

        for day, written, held in scan_days(spark, args.data, args.log, args.date, args.days):
            print(day, written, "written", held, "held")
        return 0
    df = _queries()[args.query](spark, args.data)
    if args.command == "explain":
        df.explain("formatted")
    elif args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(50, truncate=80)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
