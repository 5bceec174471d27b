"""Command line: the daily run, the history backfill, a mart refresh, the intake stream.

    python -m tillroll daily    --landing L --sales S --marts M [--as-of YYYY-MM-DD]
    python -m tillroll backfill --landing L --sales S [--start D] [--end D] [--marts M]
    python -m tillroll refresh  --sales S --marts M [--months YYYY-MM-01 ...]
    python -m tillroll intake   --landing L --sales S --checkpoint C [--marts M]

Each prints its status rows / summary.  The master and all settings come from
spark-submit; nothing here sets them.
"""

from __future__ import annotations

import argparse
import datetime as dt

from tillroll.schema import HISTORY_START


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tillroll")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("daily", "backfill", "refresh", "intake"):
        p = sub.add_parser(name)
        p.add_argument("--sales", required=True)
        p.add_argument("--marts", required=(name in ("daily", "refresh")))
        if name != "refresh":
            p.add_argument("--landing", required=True)
            p.add_argument("--format", default="array", choices=["array", "lines"])
        if name == "daily":
            p.add_argument("--as-of", default=dt.date.today().isoformat())
        if name == "backfill":
            p.add_argument("--start", default=HISTORY_START)
            p.add_argument("--end", default=(dt.date.today() - dt.timedelta(days=1)).isoformat())
        if name == "refresh":
            p.add_argument("--months", nargs="*")
        if name == "intake":
            p.add_argument("--checkpoint", required=True)
    args = ap.parse_args(argv)

    from tillroll.plans import ingest
    from tillroll.plans.marts import refresh_marts
    from tillroll.session import submitted_session
    from tillroll.sources.sales_table import date_versions, read_sales

    spark = submitted_session()
    if args.cmd == "daily":
        status = ingest.daily_load(spark, args.landing, args.sales, args.as_of, args.marts, args.format)
        status.show(truncate=False)
    elif args.cmd == "backfill":
        status = ingest.backfill(spark, args.landing, args.sales, args.start, args.end, args.marts, args.format)
        ingest.run_summary(status).show(truncate=False)
        # every failed day: at most the calendar days asked for
        for r in status.where("status = 'failed'").orderBy("batch_date").toLocalIterator():
            print(r.batch_date, r.status, r.reason)
    elif args.cmd == "refresh":
        months = [dt.date.fromisoformat(m) for m in args.months] if args.months else None
        print(refresh_marts(read_sales(spark, args.sales), args.marts, months=months,
                            versions=date_versions(spark, args.sales)))
    else:
        from tillroll.streaming.intake import start_intake
        q = start_intake(spark, args.landing, args.sales, args.checkpoint, args.marts, args.format)
        q.awaitTermination()


if __name__ == "__main__":
    main()
