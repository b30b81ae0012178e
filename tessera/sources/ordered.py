"""A stream over the rounds of a folder in the order of their names, one round per micro-batch.

Spark's own file stream goes by modification time. Here the offset is a place in the sorted names,
with the name taken last. The stream itself carries one row, the round's path; its files are read
by whoever takes the batch, with all of the cluster.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .readers import chunk_paths

FORMAT = "rounds_in_name_order"


class RoundPartition(InputPartition):
    def __init__(self, place: int, path: str):
        self.place = place
        self.path = path


class RoundsReader(DataSourceStreamReader):
    """Gives one more name per batch. The engine plans the last known batch first when a query starts
    again, which tells how far it had come."""

    def __init__(self, paths: list[str]):
        self.paths = paths
        self.taken = 0

    def _offset(self, taken: int) -> dict:
        return {"taken": taken, "last": self.paths[taken - 1] if taken else ""}

    def initialOffset(self) -> dict:
        return self._offset(0)

    def latestOffset(self) -> dict:
        return self._offset(min(self.taken + 1, len(self.paths)))

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        taken = end["taken"]
        if taken > len(self.paths) or self._offset(taken) != end:
            raise ValueError(f"{end['last']} is no longer name {taken} of the folder: earlier names came or went")
        self.taken = taken
        return [RoundPartition(i, self.paths[i]) for i in range(start["taken"], taken)]

    def read(self, partition: RoundPartition) -> Iterator[tuple]:
        yield (partition.place, partition.path)

    def commit(self, end: dict) -> None:
        self.taken = max(self.taken, end["taken"])


class RoundsInNameOrder(DataSource):
    """Option `paths`: the rounds' paths in order, as a JSON list."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "place bigint, path string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return RoundsReader(json.loads(self.options["paths"]))


def stream_rounds(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    """The stream of (place, path) over what is in the folder now, and the number of its rounds."""
    spark.dataSource.register(RoundsInNameOrder)
    paths = chunk_paths(spark, folder)
    return spark.readStream.format(FORMAT).option("paths", json.dumps(paths)).load(), len(paths)
