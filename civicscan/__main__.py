"""Command line: run any catalog job over a data folder and write its result.

    python -m civicscan list
    python -m civicscan run counts_by_year --data /root/testdata/sf0.01 --out OUT
    python -m civicscan run utility_notices --data DIR --out OUT --format csv
    python -m civicscan run counts_by_state_year --data DIR --out OUT --by-year

Reports are written by the DataFrame writer (a directory of part files):
CSV with a header and '' for empty values (like the reference's reports),
or Parquet.  ``--by-year`` writes one folder per year, replacing only the
years present.  The master is taken from the environment (spark-submit sets
it); ``--master`` overrides it for local runs.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="civicscan")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list the jobs")
    run = sub.add_parser("run", help="run one job and write its result")
    run.add_argument("job")
    run.add_argument("--data", required=True, help="folder with the input parquet tables")
    run.add_argument("--out", required=True, help="output directory")
    run.add_argument("--format", choices=["csv", "parquet"], default="csv")
    run.add_argument("--append", metavar="RUN", help="append as this run (CSV): a run counts once however often it is tried")
    run.add_argument("--by-year", action="store_true", help="one folder per year (needs a year column)")
    run.add_argument("--master", default=None)
    rep = sub.add_parser("reports", help="utility notices + summary advisories, sharing one page-date table")
    rep.add_argument("--data", required=True)
    rep.add_argument("--out", required=True)
    rep.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    from .plans.catalog import QUERIES
    if args.cmd == "list":
        for name in QUERIES:
            print(name)
        return 0
    if args.cmd == "reports":
        import os

        from .plans import notices
        from .plans.catalog import fx
        from .session import get_session, ship_package
        from .sources import csvio
        spark = get_session(args.master, app="civicscan-reports")
        ship_package(spark)
        k5, k7 = notices.notice_reports(fx(spark, args.data, "fx_utilities"), fx(spark, args.data, "fx_search_log"),
                                        fx(spark, args.data, "fx_news_log"), fx(spark, args.data, "fx_crawl"),
                                        fx(spark, args.data, "fx_summary_llm"))
        csvio.write_csv(k5, os.path.join(args.out, "utility_notices"))
        csvio.write_csv(k7, os.path.join(args.out, "summary_advisories"))
        print(f"reports: written to {args.out}")
        return 0
    if args.job not in QUERIES:
        print(f"unknown job {args.job!r}; see `python -m civicscan list`", file=sys.stderr)
        return 2

    from .session import get_session
    from .sources import csvio
    spark = get_session(args.master, app=f"civicscan-{args.job}")
    df = QUERIES[args.job](spark, args.data)
    if args.append:
        if args.by_year or args.format != "csv":
            print("--append writes CSV without year folders", file=sys.stderr)
            return 2
        done = csvio.append_run(df, args.out, args.append)
        print(f"{args.job}: run {args.append} " + (f"appended to {args.out}" if done else "had been appended"))
        return 0
    if args.by_year:
        if "year" not in df.columns:
            print("--by-year needs a 'year' column", file=sys.stderr)
            return 2
        if args.format == "csv":
            csvio.write_by_year(df, args.out)
        else:
            (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("year").parquet(args.out))
    elif args.format == "csv":
        csvio.write_csv(df, args.out)
    else:
        csvio.write_parquet(df, args.out)
    print(f"{args.job}: written to {args.out}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
