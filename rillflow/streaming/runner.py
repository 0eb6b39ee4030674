"""API-1 / API-2 / STR-3: start a streaming job from a source, a transform and a
sink, with a checkpoint in the cluster's shared checkpoint folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from rillflow.constants import CHECKPOINT_INTERVAL
from rillflow.session import checkpoint_dir, ensure_json_settings


def checkpoint_location(spark, name: str) -> str:
    """``<spark.checkpoint.dir>/<name>``: one checkpoint per job (also its
    consumer-group identity)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}"


def run_stream(source: DataFrame, transform: Callable[[DataFrame], DataFrame] | None,
               sink: Callable[[DataFrame], DataStreamWriter], *, name: str,
               checkpoint: str | None = None, trigger: str | None = CHECKPOINT_INTERVAL,
               available_now: bool = False, output_mode: str = "append") -> StreamingQuery:
    """Start ``sink(transform(source))``.

    Progress and state are checkpointed at every micro-batch (``trigger``
    interval, 5 s by default, like the reference's checkpoint interval); a
    restarted job resumes from the checkpoint. ``available_now`` processes what
    is there and stops (tests, backfills).
    """
    spark = source.sparkSession
    ensure_json_settings(spark)
    df = transform(source) if transform else source
    writer = sink(df).queryName(name).outputMode(output_mode) \
        .option("checkpointLocation", checkpoint or checkpoint_location(spark, name))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def sql_transform(view: str, sql: str) -> Callable[[DataFrame], DataFrame]:
    """API-2: a transform written as SQL over the stream registered as ``view``
    (other views it names, e.g. a dictionary, may be static tables)."""
    def apply(df: DataFrame) -> DataFrame:
        df.createOrReplaceTempView(view)
        return df.sparkSession.sql(sql)
    return apply
