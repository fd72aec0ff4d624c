"""Run a job: ``python -m affinity JOB --root FOLDER`` or with spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from affinity.plans import jobs
from affinity.streaming import tracking

BATCH = {"statistics": jobs.statistics, "itemcf": jobs.itemcf_lists,
         "content": jobs.content_lists, "offline": jobs.offline,
         "publish": jobs.publish_stream_lists}

FROM_ROWS = {"register": jobs.register_users, "profile": jobs.update_profiles,
             "intake": jobs.intake}
STREAMS = {"track": jobs.track, "online": jobs.online, "queue": jobs.queue_ratings}


def options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def main() -> None:
    parser = argparse.ArgumentParser(prog="affinity")
    parser.add_argument("job", choices=["load", *BATCH, *FROM_ROWS, "evaluate", *STREAMS])
    parser.add_argument("--root", required=True, help="folder of the tables")
    parser.add_argument("--products", help="product file for load")
    parser.add_argument("--ratings", help="rating file for load")
    parser.add_argument("--source", help="rows of a job, or what a stream reads")
    parser.add_argument("--format", default="text", help="format of the source")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                        help="option of the stream's source")
    parser.add_argument("--sink-format", default="text", help="format that track writes")
    parser.add_argument("--sink-option", action="append", default=[], metavar="KEY=VALUE",
                        help="option of what track writes, such as a topic")
    parser.add_argument("--once", action="store_true", help="stream what there is, then stop")
    args = parser.parse_args()

    spark = SparkSession.builder.appName(f"affinity-{args.job}").getOrCreate()
    if args.job == "load":
        jobs.load(spark, args.root, args.products, args.ratings)
    elif args.job == "evaluate":
        jobs.evaluate(spark, args.root).show()
    elif args.job in BATCH:
        BATCH[args.job](spark, args.root)
    elif args.job in FROM_ROWS:
        rows = spark.read.format(args.format).options(**options(args.option)).load(args.source)
        FROM_ROWS[args.job](rows, args.root)
    else:
        lines = tracking.stream_log(spark, args.source, args.format, **options(args.option))
        sink = ({"fmt": args.sink_format, **options(args.sink_option)} if args.job == "track"
                else {})
        interval = None if args.once else tracking.BATCH_INTERVAL
        STREAMS[args.job](lines, args.root, interval=interval, **sink).awaitTermination()


if __name__ == "__main__":
    main()
