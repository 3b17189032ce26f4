"""The streaming jobs as a program for spark-submit.

  enrich   raw messages -> enriched messages      (--directory: stored user documents)
  history  enriched messages -> history table
  mart     enriched messages -> latest-state table
  settle   raw messages -> accepted messages, rejected marks kept beside them
  admit    mark requests -> accepted messages, judged by the journal's tables (--school) and settled

Messages come from and go to a topic or files: ``--source kafka --source-option subscribe=...``
or ``--source parquet --source-option path=...``; likewise ``--sink``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rollmark.plans.session import SETTINGS
from rollmark.schemas import RAW_COLUMNS
from rollmark.sinks.messages import to_messages, write_messages
from rollmark.sources.directory import read_directory
from rollmark.sources.messages import decode_events, decode_requests, read_messages
from rollmark.sources.school import read_school
from rollmark.streaming.admission import SchoolSnapshots, start_admission
from rollmark.streaming.enrichment import dedupe_stream, start_enrichment, start_rejects
from rollmark.streaming.run import query_id, start_batches, supervise
from rollmark.streaming.settlement import start_settlement
from rollmark.streaming.snapshot import DirectorySnapshot
from rollmark.streaming.store import start_history, start_mart


def _pairs(items: Sequence[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="rollmark", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job", choices=["enrich", "history", "mart", "settle", "admit"])
    p.add_argument("--checkpoint", required=True, help="folder on shared storage")
    p.add_argument("--source", default="kafka")
    p.add_argument("--source-option", action="append", default=[], metavar="KEY=VALUE")
    p.add_argument("--sink", default="kafka")
    p.add_argument("--sink-option", action="append", default=[], metavar="KEY=VALUE")
    p.add_argument("--table", help="folder of the history, of the latest state or of the standing marks")
    p.add_argument("--rejects", help="folder for what a job refuses, with a reason; messages it cannot read go to <folder>-unread, "
                   "requests that do not pass to <folder>-refused")
    p.add_argument("--overwrites", help="folder for accepted marks that replaced another (settle)")
    p.add_argument("--directory", help="folder of user documents")
    p.add_argument("--directory-format", default="parquet")
    p.add_argument("--refresh-seconds", type=float, default=3600)
    p.add_argument("--school", help="folder of the journal's tables (admit); copies go to <checkpoint>-school")
    p.add_argument("--merge-every", type=int, default=16, help="batches after which a stored table is merged")
    p.add_argument("--watermark", help="forget ids after this delay, such as '2 days'")
    p.add_argument("--any-id", action="store_true", help="accept ids that are no UUIDs")
    p.add_argument("--every", help="trigger interval; without it all available data is done once")
    return p


def start(spark: SparkSession, argv: Sequence[str]) -> list[StreamingQuery]:
    """Start the queries of a job, the main one last."""
    args = parser().parse_args(argv)
    messages = read_messages(spark, args.source, stream=True, **_pairs(args.source_option))
    sink_options = _pairs(args.sink_option)

    def batch_key(rows: DataFrame, batch_id: int, checkpoint: str = args.checkpoint) -> str:
        """A run with a fresh checkpoint counts from 0 again, and must not replace another's files."""
        return f"{query_id(rows.sparkSession, checkpoint)}-{batch_id}"

    def write(rows: DataFrame, batch_id: int) -> None:
        write_messages(rows, args.sink, batch_id=batch_key(rows, batch_id), **sink_options)

    def refuse(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{args.rejects}/batch_id={batch_key(rows, batch_id)}")

    if args.job in ("history", "mart"):
        begin = start_history if args.job == "history" else start_mart
        return [begin(
            messages, args.table, args.checkpoint, every=args.every, uuid_ids=not args.any_id,
            rejects=refuse if args.rejects else None, merge_every=args.merge_every,
        )]
    beside_it = []
    if args.rejects:  # what cannot be decoded goes there by a query of its own

        beside = f"{args.checkpoint.rstrip('/')}-unread"

        def unread(rows: DataFrame, batch_id: int) -> None:
            key = batch_key(rows, batch_id, beside)
            rows.select("key", "reason").write.mode("overwrite").parquet(f"{args.rejects}-unread/batch_id={key}")

        if args.job == "admit":
            beside_it = [start_batches(decode_requests(messages)[1], unread, beside, every=args.every)]
        else:
            beside_it = [start_rejects(messages, unread, beside, watermark=args.watermark, every=args.every)]
    if args.job == "enrich":
        directory = DirectorySnapshot(
            lambda s: read_directory(s, args.directory, args.directory_format), args.refresh_seconds
        )
        return [*beside_it, start_enrichment(
            messages, directory, write, args.checkpoint, watermark=args.watermark, every=args.every
        )]

    def settled(accepted: DataFrame, rejected: DataFrame, batch_id: int) -> None:
        write(to_messages(accepted, RAW_COLUMNS), batch_id)
        if args.rejects:
            refuse(rejected, batch_id)

    def replaced(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{args.overwrites}/batch_id={batch_key(rows, batch_id)}")

    more = {
        "every": args.every, "overwrites": replaced if args.overwrites else None, "merge_every": args.merge_every,
    }
    if args.job == "admit":
        snapshots = SchoolSnapshots(
            lambda s: read_school(s, args.school), f"{args.checkpoint.rstrip('/')}-school", args.refresh_seconds)

        def unfit(rows: DataFrame, batch_id: int) -> None:
            key = batch_key(rows, batch_id)
            rows.write.mode("overwrite").parquet(f"{args.rejects}-refused/batch_id={key}")

        return [*beside_it, start_admission(
            decode_requests(messages)[0], snapshots, args.table, settled, args.checkpoint,
            refuse=unfit if args.rejects else None, **more,
        )]
    events = dedupe_stream(decode_events(messages)[0], watermark=args.watermark)
    typed = events.withColumn("LESSON_DATE", F.col("LESSON_DATE").try_cast("date"))
    return [*beside_it, start_settlement(typed, args.table, settled, args.checkpoint, **more)]


def main(argv: Sequence[str] | None = None) -> None:
    import sys

    builder = SparkSession.builder.appName("rollmark")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    supervise(start(spark, sys.argv[1:] if argv is None else argv))


if __name__ == "__main__":
    main()
