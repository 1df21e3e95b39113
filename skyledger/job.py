"""Command line for ``spark-submit``: ingest landed documents, rebuild the marts, test, or stream.

    spark-submit --py-files skyledger.zip skyledger/job.py ingest --landed DIR --root DIR
    spark-submit --py-files skyledger.zip skyledger/job.py marts --root DIR [--since DAY] [--until DAY]
    spark-submit --py-files skyledger.zip skyledger/job.py quality --root DIR
    spark-submit --py-files skyledger.zip skyledger/job.py stream --landed DIR --root DIR --job NAME [--every "10 minutes"]
    spark-submit --py-files skyledger.zip skyledger/job.py rollup --landed DIR --root DIR --job NAME

The landing folder holds ``current/``, ``hourly/`` and ``daily/``, each with folders
``location_id=…`` of JSON documents. A raw folder is fed either by ``ingest`` or by ``stream``.
"""

from __future__ import annotations

import argparse
from datetime import UTC, date, datetime
from zlib import crc32

from pyspark.sql import SparkSession

from skyledger.plans.batch import FLATTENERS, build_marts, check_quality
from skyledger.session import configure
from skyledger.sources.documents import stream_documents
from skyledger.streaming.ingest import ingest_stream
from skyledger.streaming.rollup import rollup_stream


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="skyledger.job", description=__doc__)
    actions = parser.add_subparsers(dest="action", required=True)
    for name in ("ingest", "marts", "quality", "stream", "rollup"):
        action = actions.add_parser(name)
        action.add_argument("--root", required=True, help="folder of raw and derived tables")
        if name in ("ingest", "stream", "rollup"):
            action.add_argument("--landed", required=True, help="folder of landed documents")
            action.add_argument("--per-line", action="store_true", help="one document per line")
        if name in ("stream", "rollup"):
            action.add_argument("--job", required=True, help="lasting name of this stream")
            action.add_argument("--every", help="polling interval; without it, drain and end")
        if name == "rollup":
            action.add_argument("--delay", default="2 days", help="how late a reading may come")
        if name == "marts":
            action.add_argument("--since", type=date.fromisoformat, help="first day to rebuild")
            action.add_argument("--until", type=date.fromisoformat, help="day to end before")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    configure(spark)
    if args.action == "marts":
        build_marts(spark, args.root, datetime.now(UTC).replace(tzinfo=None), since=args.since, until=args.until)
        return
    if args.action == "quality":
        check_quality(spark, args.root)
        return
    progress = f"{args.root}/_progress"
    docs = lambda kind: stream_documents(spark, f"{args.landed}/{kind}", per_line=args.per_line)
    if args.action == "rollup":
        rollup_stream(
            docs("current"), args.root, args.job, args.delay, interval=args.every, checkpoint=progress
        ).awaitTermination()
        return
    # Batch ingest is a stream that ends: what it has taken is on record, so a rerun adds nothing.
    every = args.every if args.action == "stream" else None
    job = args.job if args.action == "stream" else f"ingest-{crc32(f'{args.landed} {args.root}'.encode()):08x}"
    started = [
        ingest_stream(docs(kind), kind, args.root, job, interval=every, checkpoint=progress) for kind in FLATTENERS
    ]
    for query in started:
        query.awaitTermination()


if __name__ == "__main__":
    parsed = arguments()
    run(SparkSession.builder.appName("skyledger").getOrCreate(), parsed)
