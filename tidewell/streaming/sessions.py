"""Sessions on a stream: event-time state with a watermark, late events kept apart.

Two streams run one after the other.  The first deals every micro-batch into events that are in time and
late ones, by a watermark of its own: the highest stamp of the micro-batches before, less
the delay.  The second reads the events in time, and Spark's session windows hold the
open sessions in the state store until the watermark passes their end.  Its watermark is
never ahead of the first one's, so it drops no event, and each event is in one session or
among the late ones.

Every micro-batch owns a folder, which a repeated one replaces.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.sources.lake import list_folders, path_exists
from tidewell.streaming.landing import to_table

_EPOCH, _MARK = "epoch", "passed timestamp"


def _watermark_before(spark: SparkSession, marks: str, epoch: int) -> datetime | None:
    """The watermark that the micro-batches before one have set; the newest file is read."""
    if not path_exists(spark, marks):
        return None
    known = {int(f.rpartition("=")[2]): f for f in list_folders(spark, marks, f"{_EPOCH}=")}
    before = [n for n in known if n < epoch and list_folders(spark, known[n], "part-")]
    if not before:
        return None
    return spark.read.schema(_MARK).json(known[max(before)]).first()[0]


def deal_by_lateness(stream: DataFrame, root: str, stamp: str, delay: timedelta):
    """Write each micro-batch to ``root``/intime and ``root``/late; null stamps are late."""

    def deal(rows: DataFrame, epoch: int) -> None:
        spark = rows.sparkSession
        passed = _watermark_before(spark, f"{root}/marks", epoch)
        late = F.col(stamp).isNull()
        if passed is not None:
            late = late | (F.col(stamp) < F.lit(passed))
        split = rows.withColumn("late", late)
        for name, which in (("late", F.col("late")), ("intime", ~F.col("late"))):
            split.filter(which).drop("late").write.mode("overwrite").parquet(f"{root}/{name}/{_EPOCH}={epoch}")
        highest = spark.read.schema(rows.schema).parquet(f"{root}/intime/{_EPOCH}={epoch}").agg(F.max(stamp)).first()[0]
        marks = [m for m in (passed, None if highest is None else highest - delay) if m is not None]
        if marks:
            mark = spark.createDataFrame([(max(marks),)], _MARK)
            mark.coalesce(1).write.mode("overwrite").json(f"{root}/marks/{_EPOCH}={epoch}")

    return stream.writeStream.option("checkpointLocation", f"{root}/checkpoints/deal").trigger(availableNow=True).foreachBatch(deal).start()


def session_windows(events: DataFrame, by: Sequence[str], stamp: str, gap: timedelta, delay: timedelta, measures: Sequence[Column] = ()) -> DataFrame:
    """Closed sessions of a stream of events: begin, last event, number of events and measures."""
    seconds = f"{gap.total_seconds()} seconds"
    window = F.session_window(F.col(stamp), seconds)
    marked = events.withWatermark(stamp, f"{delay.total_seconds()} seconds")
    measured = [F.max(stamp).alias("last_event_at"), F.count("*").alias("event_count"), *measures]
    found = marked.groupBy(window.alias("session"), *by).agg(*measured)
    return found.select(*by, F.col("session.start").alias("started_at"), *[c for c in found.columns if c not in ("session", *by)])


def land_sessions(
    stream: DataFrame, root: str, by: Sequence[str], stamp: str, gap: timedelta, delay: timedelta, measures: Sequence[Column] = ()
) -> None:
    """Run both streams over all available input; sessions are appended to ``root``/sessions."""
    spark = stream.sparkSession
    deal_by_lateness(stream, root, stamp, delay).awaitTermination()
    if not path_exists(spark, f"{root}/intime"):
        return
    intime = spark.readStream.schema(stream.schema).parquet(f"{root}/intime").drop(_EPOCH)
    windows = session_windows(intime, by, stamp, gap, delay, measures)
    to_table(windows, f"{root}/sessions", f"{root}/checkpoints/sessions").awaitTermination()


def late_events(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/late").drop(_EPOCH)
