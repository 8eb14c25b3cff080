"""Jobs for spark-submit: ``spark-submit tallybrook/jobs.py <job> --content ... --events ... --out ...``.

Sources are Parquet paths or, with ``--url``, tables of a database; the analysis and export tables go
below ``--out`` or, with ``--into-database``, back to it. A job does one run and ends, except the
streams, which run at their interval (or drain what is there when none is given). The database
password is taken from the environment variable that ``--password-env`` names.
"""

import argparse
import os
import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession, functions as F

from tallybrook.operators import quality
from tallybrook.operators.enrich import export_rows
from tallybrook.plans import analysis, reports, serving
from tallybrook.schemas import envelope_schema, event_schema
from tallybrook.session import build_session
from tallybrook.sinks.tables import into_folder, overwrite_table, partitioned_export
from tallybrook.sources import jdbc, kafka, tables
from tallybrook.sources.tables import matching_tables
from tallybrook.streaming import envelope, levels, polling, serve, windows
from tallybrook.streaming.runner import run_until_stopped, start


# Row counts of the analysis tables, taken while they were written.
COUNTED, COUNTS = "table_counts", "table_name string, n bigint"


def _database(args) -> jdbc.Database:
    return jdbc.Database(args.url, args.user, os.environ.get(args.password_env), args.driver)


def _content(spark: SparkSession, args):
    if args.url and args.hash:
        return jdbc.read_hashed(spark, _database(args), args.content, args.hash, args.slices)
    if args.url:
        return jdbc.read_sliced(spark, _database(args), args.content, "id", args.slices)
    return tables.read_table(spark, args.content)


def _events(spark: SparkSession, args):
    if args.url:
        return jdbc.read_sliced(spark, _database(args), args.events, "id", args.slices)
    return tables.read_table(spark, args.events)


def _save(args):
    return jdbc.into_database(_database(args)) if args.into_database else into_folder(args.out)


def analyze(spark: SparkSession, args) -> None:
    counts: dict[str, int] = {}
    save = _save(args) if args.into_database else into_folder(args.out, counts)
    analysis.run_analysis(_content(spark, args), _events(spark, args), save)
    if counts:
        overwrite_table(spark.createDataFrame(sorted(counts.items()), COUNTS).coalesce(1), f"{args.out}/{COUNTED}")


def export(spark: SparkSession, args) -> None:
    content, events = _content(spark, args), _events(spark, args)
    analysis.run_export(content, events, _save(args))
    partitioned_export(export_rows(events, content), f"{args.out}/engagement_events_stream")


def cache(spark: SparkSession, args) -> None:
    """The cache cycle: reads the written analysis tables, so run ``analyze`` to ``--tables`` first."""
    counts = spark.read.schema(COUNTS).parquet(f"{args.tables}/{COUNTED}")
    metrics = tables.read_table(spark, f"{args.tables}/content_engagement_metrics")
    view = serving.cache_view(
        _content(spark, args),
        _events(spark, args),
        matching_tables(counts, reports.ANALYSIS_PATTERNS),
        analysis.metrics_summary(metrics),
        F.current_timestamp(),
    )
    serving.write_view(view, args.out)


def check(spark: SparkSession, args) -> None:
    content, events = _content(spark, args), _events(spark, args)
    found = {
        "domain": quality.domain_violations(content, "content").unionByName(
            quality.domain_violations(events, "engagement_events")
        ),
        "nulls": quality.null_violations(content, "content").unionByName(
            quality.null_violations(events, "engagement_events")
        ),
        "duplicates": quality.duplicate_keys(content, "content", "id", "slug").unionByName(
            quality.duplicate_keys(events, "engagement_events", "id")
        ),
        "orphans": quality.orphans(events, content),
    }
    for name, rows in found.items():
        overwrite_table(rows, f"{args.out}/{name}")


def poll(spark: SparkSession, args) -> None:
    now = datetime.now(timezone.utc) - timedelta(seconds=args.lag)

    def deliver(rows, number: int) -> None:
        jdbc.append_once(rows, _database(args), "engagement_events_stream", args.out, number, ("id", "updated_at"))

    polling.poll_changes(
        spark,
        lambda low, high: tables.changed_between(_events(spark, args), low, high),
        lambda: _content(spark, args),
        args.out,
        now,
        first_low=None if args.look_back is None else tables.look_back(now, args.look_back),
        deliver=deliver if args.into_database else None,
    )


def poll_ids(spark: SparkSession, args) -> None:
    """Serve what no run has served yet, a page at a time."""

    def page(condition: str, limit: int):
        query = jdbc.page_query(args.events, event_schema().names, condition, limit)
        return jdbc.read_query(spark, _database(args), query)

    while polling.poll_ids(
        _events(spark, args), lambda: _content(spark, args), args.out, args.limit, page if args.url else None, args.settle
    ):
        pass


def _event_files(spark: SparkSession, args):
    return spark.readStream.schema(event_schema()).option("maxFilesPerTrigger", args.files).parquet(args.events)


def stream_serve(spark: SparkSession, args) -> None:
    handler = serve.serve_events(lambda: _content(spark, args), args.out)
    run_until_stopped(start(_event_files(spark, args), handler, f"{args.out}/_checkpoint", args.interval))


def stream_windows(spark: SparkSession, args) -> None:
    handler = windows.keep_windows(f"{args.out}/windows")
    run_until_stopped(start(_event_files(spark, args), handler, f"{args.out}/_checkpoint", args.interval))


def stream_messages(spark: SparkSession, args) -> None:
    if args.servers:
        messages = kafka.kafka_stream(
            spark, args.servers, args.topic, starting=args.starting, fail_on_data_loss=args.fail_on_data_loss,
            max_offsets=args.max_offsets, min_partitions=args.min_partitions,
        )
    else:
        messages = spark.readStream.schema(envelope_schema()).option("maxFilesPerTrigger", args.files).parquet(args.events)
    if args.into_database:
        handler = envelope.append_events(_database(args), "engagement_events_stream", args.out)
    else:
        handler = envelope.store_events(args.out)
    parsed = envelope.parse_envelope(messages)
    run_until_stopped(start(parsed, handler, f"{args.out}/_checkpoint", args.interval))


def stream_tidy(spark: SparkSession, args) -> None:
    serve.tidy(spark, args.out, args.fan_out, args.ended)


JOBS = {
    "analyze": analyze,
    "export": export,
    "cache": cache,
    "check": check,
    "poll": poll,
    "poll-ids": poll_ids,
    "stream-serve": stream_serve,
    "stream-tidy": stream_tidy,
    "stream-windows": stream_windows,
    "stream-messages": stream_messages,
}


def parse_arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallybrook")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--content", help="content table")
    parser.add_argument("--events", help="events table, or the folder a stream reads")
    parser.add_argument("--out", required=True, help="folder for the results")
    parser.add_argument("--tables", help="folder of the written analysis tables (cache)")
    parser.add_argument("--interval", type=int, help="seconds between batches; default: drain and end")
    parser.add_argument("--files", type=int, default=1000, help="most files per batch")
    parser.add_argument("--lag", type=int, default=0, help="seconds the poll stays behind the clock")
    parser.add_argument("--fan-out", type=int, default=levels.FAN_OUT, help="runs of a level that are merged into one (stream-tidy)")
    parser.add_argument("--ended", action="store_true", help="the stream has ended, its last batch is merged too (stream-tidy)")
    parser.add_argument("--servers", help="message bus servers")
    parser.add_argument("--topic", default="engagement_events")
    parser.add_argument("--starting", default="latest", help="earliest, latest, or offsets per partition as JSON")
    parser.add_argument("--fail-on-data-loss", action="store_true", help="end with an error if messages are gone")
    parser.add_argument("--max-offsets", type=int, help="most messages per batch")
    parser.add_argument("--min-partitions", type=int, help="least tasks a batch of messages is read by")
    parser.add_argument("--look-back", type=int, help="minutes a first poll looks back; default: everything")
    parser.add_argument("--settle", type=int, help="id up to which nothing can be committed any more (poll-ids)")
    parser.add_argument("--limit", type=int, default=1000, help="events per poll (poll-ids)")
    parser.add_argument("--url", help="JDBC address; --content and --events are then table names")
    parser.add_argument("--user")
    parser.add_argument("--password-env", default="DB_PASSWORD")
    parser.add_argument("--driver")
    parser.add_argument("--slices", type=int, default=64, help="parallel ranges of a database scan")
    parser.add_argument("--hash", help="the database's integer hash of content.id, to slice its scan by")
    parser.add_argument("--into-database", action="store_true")
    parser.add_argument("--master", help="for local runs")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse_arguments(sys.argv[1:] if argv is None else argv)
    spark = build_session(f"tallybrook-{args.job}", args.master)
    JOBS[args.job](spark, args)


if __name__ == "__main__":
    main()
