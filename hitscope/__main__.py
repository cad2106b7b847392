"""Command line: the batch job and the streaming job.

    python -m hitscope batch  --logs L --blocks B --locations C --out DIR [--jdbc-url U ...]
    python -m hitscope stream --blocks B --locations C --out DIR --checkpoint DIR
                              (--kafka-servers S --topic T | --records DIR) [--once]

Submit with ``spark-submit -m hitscope`` or run inside a configured environment; the
master and cluster settings come from the environment, never from here. The JDBC
password is read from the environment variable named by ``--jdbc-password-env``.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from hitscope.operators.geo import build_geo_ranges, index_ranges
from hitscope.operators.windows import WINDOWED
from hitscope.plans.batch import pipeline_counts, previews, run_batch, write_corrupt_records
from hitscope.session import configure
from hitscope.sources.files import read_access_log, read_geo_blocks, read_geo_locations
from hitscope.sources.stream import read_record_stream
from hitscope.streaming.pipeline import enriched_stream
from hitscope.streaming.sink import JdbcBatchTarget, ParquetBatchTarget, start_four_tables, start_windowed_queries
from hitscope.streaming.staging import read_enriched_table, start_enriched_table, wait_for_first_batch


def _jdbc(args) -> dict | None:
    if not args.jdbc_url:
        return None
    props = {}
    if args.jdbc_user:
        props["user"] = args.jdbc_user
    if args.jdbc_password_env:
        props["password"] = os.environ.get(args.jdbc_password_env, "")
    if args.jdbc_driver:
        props["driver"] = args.jdbc_driver
    return {"url": args.jdbc_url, "properties": props}


def batch(spark: SparkSession, args) -> None:
    if args.corrupt_dir and args.logs_format == "csv":
        write_corrupt_records(spark, args.logs, args.corrupt_dir)
    raw = read_access_log(spark, args.logs, fmt=args.logs_format)
    blocks, locations = read_geo_blocks(spark, args.blocks), read_geo_locations(spark, args.locations)
    reports = run_batch(spark, raw, blocks, locations, args.out, jdbc=_jdbc(args),
                        on_error="skip" if args.keep_going else "raise",
                        jdbc_enriched=not args.no_enriched_jdbc,
                        replace="folders" if args.replace_days else "all")
    print(f"wrote {len(reports)} reports under {args.out}")
    if args.show:
        pipeline_counts(raw, blocks, locations).show(truncate=False)
        spark.read.parquet(f"{args.out.rstrip('/')}/enriched_logs_parquet").printSchema()
        for name, df in previews(reports, args.show).items():
            print(f"--- {name} ---")
            df.show(args.show, truncate=False)


def _printer(n: int):
    def for_query(name: str):
        def show(df, batch_id: int) -> None:
            print(f"=== [batch {batch_id}] {name} ===")
            df.show(n, truncate=False)
        return show
    return for_query


def stream(spark: SparkSession, args) -> None:
    if args.state_partitions:
        # frozen into each query's checkpoint at its first start
        spark.conf.set("spark.sql.shuffle.partitions", str(args.state_partitions))
    ranges = index_ranges(build_geo_ranges(read_geo_blocks(spark, args.blocks),
                                           read_geo_locations(spark, args.locations)), persist=True)
    if args.records:
        records = read_record_stream(spark, "text", path=args.records)
    else:
        records = read_record_stream(spark, "kafka", bootstrap_servers=args.kafka_servers, topic=args.topic,
                                     max_offsets_per_trigger=args.max_offsets_per_trigger,
                                     fail_on_data_loss=not args.skip_lost_offsets)
    logs = enriched_stream(records, ranges)
    trigger = {"availableNow": True} if args.once else {"processingTime": args.trigger}
    if args.stage_enriched:
        staging = start_enriched_table(logs, args.stage_enriched,
                                       f"{args.checkpoint.rstrip('/')}/enriched", trigger=trigger)
        if args.once:
            staging.awaitTermination()
        else:
            wait_for_first_batch(staging)  # the staged table exists before its readers start
        logs = read_enriched_table(spark, args.stage_enriched, logs.schema)
    jdbc = _jdbc(args)
    targets = {
        name: (JdbcBatchTarget(jdbc["url"], name, jdbc["properties"]) if jdbc
               else ParquetBatchTarget(f"{args.out.rstrip('/')}/{name}"))
        for name in WINDOWED
    }
    if args.one_query:
        query = start_four_tables(logs, targets, f"{args.checkpoint.rstrip('/')}/four_tables", trigger=trigger,
                                  output_mode=args.output_mode, on_error="skip" if args.keep_going else "raise",
                                  preview=_printer(args.show)("four_tables") if args.show else None)
        query.awaitTermination()
        return
    queries = start_windowed_queries(logs, targets, args.checkpoint, trigger=trigger,
                                     output_mode=args.output_mode,
                                     on_error="skip" if args.keep_going else "raise",
                                     preview_for=_printer(args.show) if args.show else None)
    if args.once:
        for q in queries.values():
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="hitscope")
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("batch", "stream"):
        p = sub.add_parser(name)
        p.add_argument("--blocks", required=True)
        p.add_argument("--locations", required=True)
        p.add_argument("--out", required=True)
        p.add_argument("--jdbc-url")
        p.add_argument("--jdbc-user")
        p.add_argument("--jdbc-password-env")
        p.add_argument("--jdbc-driver")
        p.add_argument("--keep-going", action="store_true",
                       help="log and skip failed database writes instead of failing")
        p.add_argument("--show", type=int, default=0,
                       help="print the first N rows of each report / micro-batch")
        if name == "batch":
            p.add_argument("--logs", required=True, nargs="+")
            p.add_argument("--logs-format", choices=["csv", "parquet"], default="csv")
            p.add_argument("--no-enriched-jdbc", action="store_true",
                           help="send only the reports to JDBC; the enriched table stays in Parquet")
            p.add_argument("--corrupt-dir", help="folder for log records whose number of fields does not fit their file's header")
            p.add_argument("--replace-days", action="store_true",
                           help="replace only the days that the logs have; reports are over all days of the table")
        else:
            p.add_argument("--checkpoint", required=True)
            p.add_argument("--kafka-servers")
            p.add_argument("--topic")
            p.add_argument("--records", help="folder of JSON record files instead of Kafka")
            p.add_argument("--trigger", default="30 seconds")
            p.add_argument("--output-mode", choices=["update", "append"], default="update",
                           help="update: re-emit changed windows (versions); append: each window once, "
                                "after the watermark passes it")
            p.add_argument("--max-offsets-per-trigger", type=int)
            p.add_argument("--skip-lost-offsets", action="store_true",
                           help="go on over offsets that the broker has already dropped")
            p.add_argument("--state-partitions", type=int,
                           help="shuffle/state partitions of the windowed queries (first start only)")
            p.add_argument("--one-query", action="store_true",
                           help="one query and one state for the four tables: records are read, parsed and geolocated once")
            p.add_argument("--once", action="store_true", help="process what is available, then stop")
            p.add_argument("--stage-enriched",
                           help="folder for an enriched Parquet table: records are parsed, geolocated "
                                "and enriched once, and the windowed queries read that table")
    args = parser.parse_args(argv)
    spark = configure(SparkSession.builder.appName(f"hitscope-{args.command}").getOrCreate())
    (batch if args.command == "batch" else stream)(spark, args)


if __name__ == "__main__":
    main()
