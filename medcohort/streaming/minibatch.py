"""Streaming k-means under Structured Streaming (L6 / L7 as a stream).

Each micro-batch updates the k-row centre table with
:func:`medcohort.operators.learners.minibatch_update`. The state is written per
batch id under a folder that the caller names beside the stream's checkpoint
location: batch ``n`` reads exactly the version of batch ``n - 1`` and writes its
own, so a batch replayed after a failure gives the same state, and a new driver
goes on where the last one ended. A missing or unreadable version fails the
batch. Versions older than the one before are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from medcohort.operators.learners import STREAM_DECAY, STREAM_TIME_UNIT, Centres, minibatch_update


def _version(base: str, batch_id: int) -> str:
    return f"{base.rstrip('/')}/batch_id={batch_id}"


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def state_frame(spark: SparkSession, base: str) -> DataFrame:
    """The newest centre table written under ``base``: ``(cluster, weight, center)``."""
    state = spark.read.parquet(base)   # two versions at most
    last = state.agg(F.max("batch_id")).first()[0]
    return state.filter(F.col("batch_id") == last).drop("batch_id")


def latest_centres(spark: SparkSession, base: str) -> Centres:
    """The newest centres written under ``base``."""
    return Centres.from_frame(state_frame(spark, base))


def start_streaming_kmeans(spark: SparkSession, stream: DataFrame, start: Centres,
                           checkpoint_location: str, state_location: str,
                           features_col: str = "features", decay: float = STREAM_DECAY,
                           time_unit: str = STREAM_TIME_UNIT, available_now: bool = True) -> StreamingQuery:
    """Start the update stream.

    ``stream`` is any streaming DataFrame with an array or vector column
    ``features_col``. Both locations are folders on storage that outlives the
    driver and belong together: use new ones for a new model. With
    ``available_now`` the query drains what is present and stops (the
    file-source idiom for incremental batch runs).
    """
    def update(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        current = start if batch_id == 0 else Centres.from_frame(session.read.parquet(_version(state_location, batch_id - 1)))
        new = minibatch_update(batch, current, features_col, decay, time_unit)
        new.coalesce(1).write.mode("overwrite").parquet(_version(state_location, batch_id))   # k rows
        if batch_id > 1:
            _delete(session, _version(state_location, batch_id - 2))

    writer = stream.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
