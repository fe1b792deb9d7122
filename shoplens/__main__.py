"""Command-line launcher: streaming jobs and dashboard reports.

    python -m shoplens job dau --source kafka --bootstrap host:9092 --out DIR --checkpoint DIR
    python -m shoplens job alerts --source files --topics DIR --out DIR --checkpoint DIR
    python -m shoplens compact dau --out DIR [--to TABLE_DIR]
    python -m shoplens report kpi --dau DIR --orders DIR --date 2024-01-15
    python -m shoplens report hourly --id dau --dau DIR --date 2024-01-15
    python -m shoplens report search --sales DIR --date 1996-09-17 --keyword red --page 1 --size 5

Jobs run until stopped (``--once`` processes what is available and exits).
Reports read a job's folder or its compacted table and print their bounded answers
(3 KPI rows, 24 hours, or one JSON object with total, pies and page) as JSON lines.
"""

from __future__ import annotations

import argparse
import functools
import json
import sys

from shoplens.constants import (EVENT_LOG_TOPIC, ORDER_DETAIL_TOPIC, ORDER_INFO_TOPIC,
                                STARTUP_LOG_TOPIC)

#: Rows of a search page, which the driver prints.
MAX_PAGE = 10_000
JOBS = ["dau", "orders", "alerts", "sales", "router", "collector"]


def _topic(spark, args, topic):
    from shoplens.streaming.sources import topic_stream
    return topic_stream(spark, topic, fmt=args.source,
                        bootstrap_servers=args.bootstrap, group_id=args.group,
                        starting_offsets=args.starting_offsets, path=args.topics)


def run_job(spark, args) -> list:
    from pyspark.sql import functions as F
    from shoplens import schemas
    from shoplens.functions import parse
    from shoplens.sources.tables import jdbc_lookup, read_dimension
    from shoplens.streaming import jobs
    trigger = {"availableNow": True} if args.once else {"processingTime": args.trigger}
    fmt = args.source
    if args.name == "dau":
        parse_dau = functools.partial(parse.startup_logs, tz=args.tz)
        return [jobs.start_dau(_topic(spark, args, STARTUP_LOG_TOPIC), args.out, args.checkpoint, trigger, parse_dau, counts=True)]
    if args.name == "orders":
        return [jobs.start_orders(_topic(spark, args, ORDER_INFO_TOPIC), args.out,
                                  f"{args.out}_rejects", args.checkpoint, trigger, counts=True)]
    if args.name == "alerts":
        parse_events = functools.partial(parse.event_logs, tz=args.tz)
        return [jobs.start_alerts(_topic(spark, args, EVENT_LOG_TOPIC), args.out, args.checkpoint, args.window, args.slide,
                                  args.accounts, args.throttle, trigger, parse_events, args.show)]
    if args.name == "sales":
        # order_detail carries no time of its own: both sides take the
        # message time as event time
        messages = jobs.order_and_detail_messages(_topic(spark, args, ORDER_INFO_TOPIC),
                                                  _topic(spark, args, ORDER_DETAIL_TOPIC))
        if args.users_url:
            lookup = jdbc_lookup(spark, {"url": args.users_url, "dbtable": args.users})
        else:
            lookup = jobs.dimension_lookup(lambda: read_dimension(spark, fmt=args.users_format, path=args.users))
        return [jobs.start_sales(messages, args.out, args.checkpoint, lookup, args.as_of, args.bound, trigger)]
    if args.name == "router":
        feed = spark.readStream.schema(schemas.CHANGE_ENTRY).json(args.changes)
        return [jobs.start_change_router(feed, args.checkpoint, fmt, args.topics, args.bootstrap, trigger)]
    if args.name == "collector":
        raw = spark.readStream.format("text").load(args.raw) \
            .withColumn("received_ts", F.unix_millis(F.current_timestamp()))
        return [jobs.start_log_collector(raw, args.checkpoint, args.out, fmt, args.topics, args.bootstrap, trigger)]
    raise ValueError(args.name)


def run_compact(spark, args) -> None:
    """Fold a stopped job's batches into its base, in place; with ``--to``, also write the table, partitioned
    by day, to a new folder."""
    from shoplens.streaming import jobs
    for store in jobs.STORES[args.name](spark, args.out):
        store.compact()
    if args.to:
        read, day = {"dau": (jobs.read_dau, "log_date"), "orders": (jobs.read_orders, "create_date"),
                     "sales": (jobs.read_sales, "dt")}[args.name]
        read(spark, args.out).write.mode("errorifexists").partitionBy(day).parquet(args.to)


def run_report(spark, args) -> list[dict]:
    from shoplens.operators import search
    from shoplens.plans import reports
    from shoplens.streaming import jobs

    def table(path, kind, read, day, days):
        """The days of a job's table (batches and base alike), or of an exported one."""
        from pyspark.sql import functions as F
        if jobs.STORES[kind](spark, path)[-1 if kind != "sales" else 2].manifest():
            return read(spark, path, days)
        from shoplens.sources.tables import read_serving_table
        return read_serving_table(spark, path).withColumn(day, F.col(day).cast("string"))

    from shoplens.functions.timeparts import previous_day
    both = [args.date, previous_day(args.date)]

    def rows(df):
        return [r.asDict() for r in df.collect()]   # bounded answers only

    if args.name == "kpi":
        dau = table(args.dau, "dau", jobs.read_dau, "log_date", None)   # a device's first day may be any
        actives, amounts = jobs.dau_counts(spark, args.dau, [args.date]), jobs.order_counts(spark, args.orders, [args.date])
        if actives is not None and amounts is not None:
            return rows(reports.kpi_panel_of_counts(actives, dau, amounts, args.date))
        orders = table(args.orders, "orders", jobs.read_orders, "create_date", [args.date])
        return rows(reports.kpi_panel_for_date(dau, orders, args.date))
    if args.name == "hourly":
        counts = jobs.dau_counts(spark, args.dau, both) if args.id == "dau" else jobs.order_counts(spark, args.orders, both)
        if counts is not None:
            return rows(reports.hourly_compare_of_counts(args.id, counts, args.date))
        source = (table(args.dau, "dau", jobs.read_dau, "log_date", both) if args.id == "dau"
                  else table(args.orders, "orders", jobs.read_orders, "create_date", both))
        return rows(reports.realtime_hour(args.id, source, args.date))
    if args.name == "search":
        if not 0 <= args.size <= MAX_PAGE:
            raise ValueError(f"--size is at most {MAX_PAGE}: a page is printed by the driver")
        rep = search.sale_report(table(args.sales, "sales", jobs.read_sales, "dt", None), args.date, args.keyword, args.page, args.size,
                                 args.empty_keyword, materialize="checkpoint")
        return [json.loads(r["answer"]) for r in rows(search.report_json(rep))]
    raise ValueError(args.name)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="shoplens")
    sub = p.add_subparsers(dest="cmd", required=True)
    j = sub.add_parser("job")
    j.add_argument("name", choices=JOBS)
    j.add_argument("--source", choices=["kafka", "files", "log"], default="kafka")
    j.add_argument("--bootstrap")
    j.add_argument("--group")
    j.add_argument("--starting-offsets", default="latest")
    j.add_argument("--topics", help="folder of the topics (source/sink 'files' or 'log')")
    j.add_argument("--out", required=True)
    j.add_argument("--checkpoint", required=True)
    j.add_argument("--trigger", default="3 seconds")
    j.add_argument("--once", action="store_true")
    j.add_argument("--tz", default="UTC")
    j.add_argument("--window", default="5 minutes")
    j.add_argument("--slide", default="6 seconds")
    j.add_argument("--accounts", type=int, default=3)
    j.add_argument("--throttle", default="1 minute")
    j.add_argument("--show", type=int, default=0, help="also print so many alerts of each batch")
    j.add_argument("--bound", default="30 minutes")
    j.add_argument("--as-of", dest="as_of")
    j.add_argument("--users")
    j.add_argument("--users-format", default="parquet")
    j.add_argument("--users-url", help="JDBC URL; --users is then the table, read by id ranges for each batch")
    j.add_argument("--changes", help="folder of change entries (router)")
    j.add_argument("--raw", help="folder of raw log lines (collector)")
    c = sub.add_parser("compact")
    c.add_argument("name", choices=["dau", "orders", "alerts", "sales"])
    c.add_argument("--out", required=True, help="the job's folder")
    c.add_argument("--to", help="a new folder for a day-partitioned copy")
    r = sub.add_parser("report")
    r.add_argument("name", choices=["kpi", "hourly", "search"])
    r.add_argument("--date", required=True)
    r.add_argument("--id", default="dau", choices=["dau", "order_amount"])
    r.add_argument("--dau")
    r.add_argument("--orders")
    r.add_argument("--sales")
    r.add_argument("--keyword", default="")
    r.add_argument("--page", type=int, default=1)
    r.add_argument("--size", type=int, default=10)
    r.add_argument("--empty-keyword", dest="empty_keyword", default="none", choices=["none", "all"])
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parser().parse_args(argv)
    if spark is None:
        from shoplens.config import build_session
        spark = build_session(app=f"shoplens-{args.cmd}-{args.name}", cluster=True)
    if args.cmd == "job":
        from shoplens.streaming import topic_log
        queries = run_job(spark, args)
        for q in queries:
            if args.source == "log" and args.group:
                topic_log.finish(q, args.topics, args.group)
            else:
                q.awaitTermination()
        return 0
    if args.cmd == "compact":
        run_compact(spark, args)
        return 0
    for row in run_report(spark, args):
        print(json.dumps(row, ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
