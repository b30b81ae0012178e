"""The chunk loop as a stream: every file of a folder is one micro-batch and one round."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.clustering import Bfr, State
from ..sources.ordered import stream_rounds
from ..sources.readers import read_points, stream_points


def run_stream(
    spark: SparkSession, folder: str, bfr: Bfr, checkpoint: str, points: DataFrame | None = None
) -> State:
    """Work off the files now in `folder`, one per round, and finish.

    The file source takes files by modification time; `run_rounds` goes by their names.
    A batch that is run again after a failure loads the state of the round before it and replaces
    its own tables.
    """
    stream = stream_points(spark, folder) if points is None else points
    last = {"round": 0}

    def take(batch: DataFrame, batch_id: int) -> None:
        state = bfr.round(batch, bfr.load(batch_id))
        last["round"] = state.round

    query = (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return bfr.finish(bfr.load(last["round"]))


def run_rounds(
    spark: SparkSession,
    folder: str,
    bfr: Bfr,
    checkpoint: str,
    read: Callable[[SparkSession, str], DataFrame] = read_points,
) -> State:
    """Work off what is now in `folder` in the order of names, a file or folder per round, and finish.

    Modification times don't matter. A run that failed goes on with the round it failed in, from the
    state before it; if none is left to do, the result is the same again.
    """
    rounds, n = stream_rounds(spark, folder)

    def take(batch: DataFrame, batch_id: int) -> None:
        for r in batch.orderBy("place").collect():
            bfr.round(read(spark, r.path), bfr.load(r.place))

    query = rounds.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).start()
    try:
        # A micro-batch takes one round and the next one follows at once, until no name is left.
        query.processAllAvailable()
    finally:
        query.stop()
    return bfr.finish(bfr.load(n))
