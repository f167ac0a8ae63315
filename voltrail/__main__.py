"""Command line of the jobs: loads, summaries, unpacking, streams."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from voltrail.operators import audit
from voltrail.operators.summaries import SUMMARIES
from voltrail.plans import catalog, compaction, jobs
from voltrail.session import build_session
from voltrail.streaming.ingest import ingest_stream
from voltrail.streaming.unpack import message_stream, unpack_notified, unpack_notified_stream, unpack_to_files

#: Rows of each summary that the jobs show.
PREVIEW_ROWS = 5


def _table(args) -> str:
    return f"{args.namespace}.{jobs.BASE_TABLE}"


def load(spark: SparkSession, args) -> None:
    catalog.ensure_namespace(spark, args.namespace)
    jobs.ingest_and_summarize(
        spark, args.input_path, args.namespace, args.load_id, provider=args.provider, evolve=args.evolve
    ).show(truncate=False)


def _tell(spark: SparkSession, namespace: str) -> None:
    """Rows of each summary table, from one job, and the first rows of each."""
    tables = {name: jobs.read_summary(spark, namespace, name) for name in SUMMARIES}
    audit.table_stats(tables).show(truncate=False)
    for name, df in tables.items():
        print(name)
        audit.preview(df, ["vin_id", "date"], PREVIEW_ROWS).show(truncate=False)


def summaries(spark: SparkSession, args) -> None:
    jobs.refresh_summaries(spark, _table(args), args.namespace, args.provider)
    _tell(spark, args.namespace)


def days(spark: SparkSession, args) -> None:
    jobs.refresh_summary_days(spark, _table(args), args.namespace, args.days)
    _tell(spark, args.namespace)


def pack(spark: SparkSession, args) -> None:
    print(compaction.compact(spark, _table(args), tuple(args.settled)), "partitions packed")


def unpack(spark: SparkSession, args) -> None:
    messages = spark.read.schema("body string").json(args.messages)
    unpack_notified(messages, args.root, args.target, args.manifest, args.run_id).groupBy("status").count().show()


def stream_load(spark: SparkSession, args) -> None:
    catalog.ensure_namespace(spark, args.namespace)
    ingest_stream(
        spark, args.input_path, _table(args), args.checkpoint, provider=args.provider
    ).awaitTermination()


def stream_unpack(spark: SparkSession, args) -> None:
    unpack_to_files(
        spark, args.source, args.target, args.manifest, args.checkpoint, glob=args.glob
    ).awaitTermination()


def stream_notified(spark: SparkSession, args) -> None:
    unpack_notified_stream(
        message_stream(spark, args.messages),
        args.root,
        args.target,
        args.manifest,
        args.checkpoint,
        remember=args.remember,
    ).awaitTermination()


def parser() -> argparse.ArgumentParser:
    whole = argparse.ArgumentParser(prog="voltrail", description=__doc__)
    commands = whole.add_subparsers(required=True)

    def command(run, name: str, text: str, *names: str) -> argparse.ArgumentParser:
        own = commands.add_parser(name, help=text)
        own.set_defaults(run=run)
        for positional in names:
            own.add_argument(positional)
        return own

    own = command(load, "load", "landing folder to table and summaries", "input_path", "namespace")
    own.add_argument("--load-id", required=True, help="name of this load; the same name replaces it")
    own.add_argument("--provider", default="parquet", help="table format")
    own.add_argument("--evolve", action="store_true", help="load columns outside the contract too")
    own = command(summaries, "summaries", "all three summaries anew", "namespace")
    own.add_argument("--provider", default="parquet", help="table format")
    own = command(days, "days", "the summaries of some days anew", "namespace")
    own.add_argument("days", nargs="+", type=dt.date.fromisoformat, help="days as YYYY-MM-DD")
    own = command(unpack, "unpack", "archives named by messages", "messages", "root", "target", "manifest")
    own.add_argument("--run-id", required=True, help="name of this run; the same name replaces its manifest")
    own = command(stream_load, "stream-load", "new landing files to the table", "input_path", "namespace", "checkpoint")
    own.add_argument("--provider", default="parquet", help="table format")
    own = command(
        stream_unpack, "stream-unpack", "new archives to files", "source", "target", "manifest", "checkpoint"
    )
    own.add_argument("--glob", help="names of the archives to take")
    own = command(
        stream_notified, "stream-notified", "archives named by arriving messages", "messages", "root", "target",
        "manifest", "checkpoint",
    )
    own.add_argument("--remember", default="7 days", help="how long a message sent again is known")
    own = command(pack, "compact", "small loads of each day put together", "namespace")
    own.add_argument("--settled", nargs="*", default=[], help="batch loads that will not be loaded again")
    return whole


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or build_session("voltrail-batch"), args)


if __name__ == "__main__":
    main()
