"""The three jobs as programs (API-1): ``python -m rillflow.jobs <job> ...``.

    log      topic of behaviour logs -> five channel topics and the rejected messages
    dim      topic of database changes + topic of config envelopes -> change log
             (and, on demand, the dimension snapshot)
    comment  topic of database changes + dictionary table -> enriched comments

Topics are Kafka topics (``--bootstrap-servers``) or folders of ``(seq, value)``
files (``--source``). Checkpoints go under ``spark.checkpoint.dir``; with
``--available-now`` a job processes what is there and stops.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from rillflow.constants import CHECKPOINT_INTERVAL, TOPIC_DB, TOPIC_LOG
from rillflow.operators.comments import dictionary_from_snapshot
from rillflow.operators.config import read_config_table
from rillflow.operators.position import UNITS
from rillflow.session import ensure_json_settings
from rillflow.streaming import topics
from rillflow.streaming.comment_job import CommentBatchWriter
from rillflow.streaming.dim_job import (
    ConfigBatchWriter, DimBatchWriter, SnapshotStore, compact_snapshot,
)
from rillflow.streaming.log_job import LogBatchWriter, tagged_stream
from rillflow.streaming.runner import checkpoint_location, run_stream


#: of a micro-batch: files, or thousands of Kafka records
MAX_PER_TRIGGER = 1000


def _source(spark, args, topic, path, part="", starting=None):
    """``part``: queries of one job have consumer groups of their own, so that each
    reads the whole topic."""
    return topics.read_topic(spark, topic, bootstrap_servers=args.bootstrap_servers,
                             path=path, starting=starting or args.starting,
                             group_id=args.name + part, max_per_trigger=args.max_per_trigger
                             * (1000 if args.bootstrap_servers else 1))


def _run(args, source, transform, sink):
    return run_stream(source, transform, sink, name=args.name,
                      checkpoint=args.checkpoint, trigger=args.trigger,
                      available_now=args.available_now)


def run_log(spark, args):
    """The five channels and the rejected messages from one read of the topic."""
    zone = args.zone or spark.conf.get("spark.sql.session.timeZone")
    state = args.state_path or checkpoint_location(spark, args.name) + "_devices"
    writer = LogBatchWriter(state, args.sink, zone, bootstrap_servers=args.bootstrap_servers,
                            dirty_topic=args.dirty_topic)
    return _run(args, _source(spark, args, TOPIC_LOG, args.source), tagged_stream,
                lambda df: df.writeStream.foreachBatch(writer))


def run_dim(spark, args):
    if not args.ops_path:
        raise SystemExit("the dim job needs --ops-path, the folder of its config ops")
    if args.snapshot and not args.available_now:
        raise SystemExit("--snapshot is written when the job stops: it needs --available-now "
                         "(--snapshot-store is kept up by a running job)")
    # the whole feed: an earlier op counts until a later one replaces it
    cfg_src = _source(spark, args, args.config_topic, args.config_source, "_config",
                      args.config_starting)
    ops_name = args.name + "_config"
    config_writer = ConfigBatchWriter(args.ops_path, args.config_ts_unit)
    ops_query = run_stream(cfg_src, None, lambda df: df.writeStream.foreachBatch(config_writer),
                           name=ops_name,
                           checkpoint=(args.checkpoint + "_config" if args.checkpoint
                                       else checkpoint_location(spark, ops_name)),
                           trigger=args.trigger, available_now=args.available_now)
    if args.available_now:
        ops_query.awaitTermination()
    preload = read_config_table(spark, args.preload, args.preload_url, args.preload_table) \
        if args.preload or args.preload_url else None
    writer = DimBatchWriter(args.ops_path, args.sink, args.sink + "_quarantine",
                            args.database, preload=preload, as_of=args.as_of,
                            unit=args.ts_unit)
    store = SnapshotStore(args.snapshot_store) if args.snapshot_store else None

    def each(batch, batch_id):
        writer(batch, batch_id)
        if store:
            store.compact(batch.sparkSession, args.sink, args.ops_path)

    src = _source(spark, args, TOPIC_DB, args.source)
    query = _run(args, src, None, lambda df: df.writeStream.foreachBatch(each))
    if args.snapshot:
        query.awaitTermination()
        compact_snapshot(spark, args.sink, args.ops_path).write.mode("overwrite") \
            .parquet(args.snapshot)
    return query


def run_comment(spark, args):
    def dictionary(s):
        dic = s.read.parquet(args.dictionary)
        # a snapshot of the dimension job holds the dictionary as one of its tables
        return dictionary_from_snapshot(dic, args.dictionary_table) if args.dictionary_table else dic

    writer = CommentBatchWriter(dictionary, args.sink, args.database,
                                refresh_seconds=args.refresh_seconds,
                                bootstrap_servers=args.bootstrap_servers)
    src = _source(spark, args, TOPIC_DB, args.source)
    return _run(args, src, None, lambda df: df.writeStream.foreachBatch(writer))


JOBS = {"log": run_log, "dim": run_dim, "comment": run_comment}


def parse_args(argv):
    p = argparse.ArgumentParser(prog="rillflow.jobs")
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("--source", help="folder of (seq, value) files for the input topic")
    p.add_argument("--bootstrap-servers")
    p.add_argument("--starting", default="latest")
    p.add_argument("--max-per-trigger", type=int, default=MAX_PER_TRIGGER,
                   help="files, or Kafka records in thousands, of a micro-batch")
    p.add_argument("--sink", required=True, help="output folder")
    p.add_argument("--name", help="query name, consumer group and checkpoint folder")
    p.add_argument("--checkpoint")
    p.add_argument("--trigger", default=CHECKPOINT_INTERVAL)
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--zone", help="zone of dates in the log job (default: session zone)")
    p.add_argument("--dirty-topic", default="dirty", help="log job: topic of rejected messages")
    p.add_argument("--state-path", help="log job: folder of the devices' first days")
    p.add_argument("--database", default="shop")
    p.add_argument("--config-topic", default="topic_config")
    p.add_argument("--config-source")
    p.add_argument("--ops-path")
    p.add_argument("--config-starting", default="earliest")
    p.add_argument("--preload", help="dim job: the config table as files")
    p.add_argument("--preload-url", help="dim job: the config table by JDBC")
    p.add_argument("--preload-table")
    p.add_argument("--as-of", action="store_true")
    p.add_argument("--ts-unit", default="ms", choices=sorted(UNITS),
                   help="dim job: unit of the changes' ts")
    p.add_argument("--config-ts-unit", default="ms", choices=sorted(UNITS))
    p.add_argument("--snapshot", help="dim job: write the dimension cells when the job stops")
    p.add_argument("--snapshot-store", help="dim job: keep the dimension cells in buckets, "
                   "compacted after each micro-batch")
    p.add_argument("--dictionary")
    p.add_argument("--dictionary-table", help="comment job: --dictionary is a dimension "
                   "snapshot, and this sink table of it the dictionary")
    p.add_argument("--refresh-seconds", type=float, default=0.0)
    args = p.parse_args(argv)
    args.name = args.name or f"{args.job}_job"
    return args


def main(argv=None, spark: SparkSession | None = None):
    args = parse_args(sys.argv[1:] if argv is None else argv)
    spark = spark or SparkSession.builder.appName(f"rillflow-{args.job}").getOrCreate()
    ensure_json_settings(spark)
    query = JOBS[args.job](spark, args)
    if argv is None:
        query.awaitTermination()
    return query


if __name__ == "__main__":
    main()
