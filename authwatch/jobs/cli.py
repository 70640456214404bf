"""``python -m authwatch <job> ...``; options mirror the library arguments."""

from __future__ import annotations

import argparse
import os

from authwatch.operators import split
from authwatch.plans import daily, ingest
from authwatch.session import build_session
from authwatch.sources import bus, logs, snapshots, tables
from authwatch.streaming import live


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="authwatch")
    jobs = top.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("ingest", help="log files -> bus or message files")
    job.add_argument("--logs", required=True, help="glob of log files")
    job.add_argument("--host", required=True)
    job.add_argument("--log-tz", default="UTC")
    job.add_argument("--servers", help="publish to these brokers")
    job.add_argument("--topic", default=bus.TOPIC)
    job.add_argument("--out", help="store messages as files instead")
    job.add_argument("--rows-per-file", type=int, help="with --out: messages of a file at most")
    job.add_argument("--checkpoint", help="remember finished files; later runs read new ones only")
    job.add_argument("--trigger", help="with --checkpoint: keep running at this interval")
    job.add_argument("--max-files", type=int, help="with --checkpoint: files per micro-batch")
    job.add_argument("--archive", help="with --checkpoint: move finished files to this folder")

    job = jobs.add_parser("files", help="log files that an ingest with --checkpoint has finished")
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--out", help="write all of them as JSON here instead of printing 1,000")

    job = jobs.add_parser("live", help="bus -> events table and alerts, endless")
    job.add_argument("--root", required=True)
    job.add_argument("--servers", help="brokers; without them --replay is read")
    job.add_argument("--topic", default=bus.TOPIC)
    job.add_argument("--replay", help="folder of stored messages")
    job.add_argument("--max-rows", type=int,
                     help="of a replay that was stored with --rows-per-file: messages per micro-batch")
    job.add_argument("--drain", action="store_true", help="stop when the input is used up")
    job.add_argument("--trigger", default="5 seconds")
    job.add_argument("--max-per-trigger", type=int,
                     help="messages per micro-batch; of a replay, files (default 10000 messages)")
    job.add_argument("--files", type=int, help="event files per micro-batch and day")
    job.add_argument("--threshold", type=int, default=int(os.getenv("BF_THRESHOLD", "60")))
    job.add_argument("--window-min", type=int, default=int(os.getenv("BF_WINDOW_MIN", "1")))

    job = jobs.add_parser("settle", help="live events of closed days -> events table")
    job.add_argument("--root", required=True)
    job.add_argument("--events", required=True)
    job.add_argument("--from", dest="day_from")
    job.add_argument("--to", dest="day_to")
    job.add_argument("--no-late", action="store_true",
                     help="leave late events of days before --from in the live folder")
    job.add_argument("--target-mb", type=int, default=tables.TARGET_BYTES >> 20,
                     help="size of a stored file; a day is merged in as many parts")
    job.add_argument("--reject-limit", type=float,
                     help="fail above so many rejected values a row, and store nothing")
    job.add_argument("--keep-live", action="store_true", help="do not remove merged live batches")

    job = jobs.add_parser("compact", help="join small files of the live folder")
    job.add_argument("--root", required=True)
    job.add_argument("--from", dest="day_from")
    job.add_argument("--to", dest="day_to")
    job.add_argument("--target-mb", type=int, default=tables.TARGET_BYTES >> 20)

    job = jobs.add_parser("expire", help="remove old versions of the events table")
    job.add_argument("--events", required=True)
    job.add_argument("--keep", type=int, default=2, help="newest versions that stay")

    job = jobs.add_parser("metrics", help="daily metrics of a day or of all days")
    job.add_argument("--events", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--date", help="YYYY-MM-DD, default today (UTC)")
    job.add_argument("--all", action="store_true", help="every stored day in one job")
    job.add_argument("--changed", action="store_true",
                     help="the days that merges changed since the last --changed")
    job.add_argument("--live", help="root of the stream; settle the day first")
    job.add_argument("--state", help="with --changed: keep the days' sketches here, too")
    job.add_argument("--threshold", type=int, default=10)
    job.add_argument("--report-tz", default="UTC")

    job = jobs.add_parser("report", help="report tables of a day or range")
    job.add_argument("--events", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--from", dest="day_from", required=True)
    job.add_argument("--to", dest="day_to")
    job.add_argument("--report-tz", default="UTC")
    job.add_argument("--live", help="root of the stream; settle the days first")

    job = jobs.add_parser("mail", help="rows of the daily mail")
    job.add_argument("--metrics", required=True)
    job.add_argument("--date", help="YYYY-MM-DD, default yesterday (UTC)")
    job.add_argument("--out", help="write the rows as JSON here instead of printing them")

    job = jobs.add_parser("split", help="log files -> one file per day")
    job.add_argument("--logs", required=True, help="glob of log files")
    job.add_argument("--year", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--max-rows", type=int, help="lines per day at most; says what is left out")
    job.add_argument("--left-out", help="write the days that lose lines as JSON here, all of them")
    return top


def run_live(spark, args) -> None:
    if args.servers:
        source = bus.read_bus(spark, bus.bus_options(
            args.servers, args.topic, max_per_trigger=args.max_per_trigger or 10_000))
    else:
        source = bus.replay_bus(spark, args.replay, args.max_per_trigger, args.max_rows)
    minutes = f"{args.window_min} minutes"
    queries = live.run_stream(source, args.root, None if args.drain else args.trigger,
                              args.files, window=minutes, watermark=minutes, threshold=args.threshold)
    if args.drain:
        live.await_all(queries)
    else:
        live.await_any(spark)


def run_ingest(spark, args) -> None:
    if args.checkpoint:
        stream = ingest.file_message_stream(
            spark, args.logs, args.host, log_tz=args.log_tz, max_files=args.max_files,
            archive=args.archive)
        ingest.start_ingest(stream, args.checkpoint, args.servers, args.topic, args.out,
                            args.trigger).awaitTermination()
        return
    messages = ingest.file_messages(spark, args.logs, args.host, log_tz=args.log_tz)
    if args.servers:
        bus.write_bus(messages, args.servers, args.topic)
    else:
        bus.store_messages(messages, args.out, args.rows_per_file)


def run_files(spark, args) -> None:
    files = logs.finished_files(spark, args.checkpoint)
    if args.out:
        files.write.mode("overwrite").json(args.out)
    else:
        files.orderBy("file_path").show(1000, truncate=False)
        print(f"{files.count()} files finished")


def run_mail(spark, args) -> None:
    rows = daily.mail_rows(spark, args.metrics, args.date)
    if args.out:
        rows.write.mode("overwrite").json(args.out)
    else:
        # A mail has a summary and two short lists.
        rows.orderBy("section", "position").show(100, truncate=False)


def run_split(spark, args) -> None:
    lines = logs.read_logs(spark, args.logs)
    if args.max_rows is None:
        split.split_by_date(lines, args.year, args.out)
        return
    split.split_by_date_capped(lines, args.year, args.out, args.max_rows)
    left_out = split.split_left_out(split.dated_lines(lines, args.year), args.max_rows)
    left_out = left_out.filter("n_left_out > 0")
    if args.left_out:
        left_out.write.mode("overwrite").json(args.left_out)
        return
    days = left_out.count()
    left_out.orderBy("file_name").show(1000, truncate=False)
    if days > 1000:
        print(f"{days - 1000} more days lose lines; --left-out writes them all")


def main(argv=None, spark=None) -> None:
    args = parser().parse_args(argv)
    spark = spark or build_session(f"authwatch-{args.job}")
    if args.job == "ingest":
        run_ingest(spark, args)
    elif args.job == "files":
        run_files(spark, args)
    elif args.job == "live":
        run_live(spark, args)
    elif args.job == "settle":
        tables.settle_days(spark, live.events_path(args.root), args.events,
                           args.day_from, args.day_to, retire=not args.keep_live,
                           late=not args.no_late, target_bytes=args.target_mb << 20,
                           reject_limit=args.reject_limit)
    elif args.job == "compact":
        gone = tables.compact_live(spark, live.events_path(args.root), args.day_from,
                                   args.day_to, args.target_mb << 20)
        print(f"{gone} files joined")
    elif args.job == "expire":
        print(f"{snapshots.expire(spark, args.events, args.keep)} files removed")
    elif args.job == "metrics":
        options = {"threshold": args.threshold, "report_tz": args.report_tz}
        source = live.events_path(args.live) if args.live else None
        if args.changed:
            days = daily.refresh_metrics(spark, args.events, args.out, source, state=args.state,
                                         **options)
            print("computed:", *sorted(map(str, days)))
        elif args.all:
            daily.backfill_metrics(spark, args.events, args.out, live=source, **options)
        else:
            daily.run_daily_metrics(spark, args.events, args.out, args.date, source, **options)
    elif args.job == "report":
        daily.write_report(spark, args.events, args.out, args.day_from, args.day_to,
                           args.report_tz, live.events_path(args.live) if args.live else None)
    elif args.job == "mail":
        run_mail(spark, args)
    elif args.job == "split":
        run_split(spark, args)
