"""The feed: recorded messages, resumed at an event-time cursor.

The recorder of the live feed closes a folder ``taken_us=N`` every so often, N being the time of closing in
microseconds; a folder is put in place when it is complete. What lies in it happened before N, up to the
difference of two clocks (``SKEW_US``). So a cursor says which folders can hold later messages, and only these are
listed by the stream's offsets, opened and read. The offset is ``{"time_us": n}``: folders closed before n were read.

The stream itself carries folder names; a micro-batch reads its folders with Spark's own text scan, so that messages are
decoded once for everything that is made of them (see ``streaming/landing.py``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from feedloom.operators.feed import event_time, parse_messages
from feedloom.session import qualified
from feedloom.sources.commits import folders_in
from feedloom.sources.files import file_system, folder_names
from feedloom.sources.hour_files import cursor

TAKEN = "taken_us="
SKEW_US = 60_000_000


def saved_cursor(bronze: DataFrame) -> int | None:
    """Highest event time of the posts landed so far; none for an empty table or a cursor of 0."""
    return cursor(bronze).first().time_us or None


def from_cursor(messages: DataFrame, start_us: int) -> DataFrame:
    """Messages from an event time on, and those without a readable one, so that the dead letters get them."""
    return messages.where(event_time().isNull() | (event_time() >= start_us))


@dataclass
class Folders(InputPartition):
    """Recorder folders of a micro-batch."""

    names: list[str]


class RecordedFolders(DataSource):
    """Folders a recorder has closed. Options: ``path``, and ``from_us`` for the first closing time taken."""

    @classmethod
    def name(cls) -> str:
        return "recorded_folders"

    def schema(self) -> str:
        return "folder STRING, taken_us BIGINT"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return RecordedFoldersReader(self.options["path"], int(self.options["from_us"]))


class RecordedFoldersReader(DataSourceStreamReader):
    def __init__(self, path: str, from_us: int):
        self.path = path
        self.from_us = from_us

    def _closed(self) -> list[tuple[int, str]]:
        """Closing time and name of the folders; nothing in them is listed."""
        files, root = file_system(self.path)
        names = [name for name in folder_names(files, root) if name.startswith(TAKEN)]
        return sorted((int(name[len(TAKEN) :]), name) for name in names)

    def initialOffset(self) -> dict:
        return {"time_us": self.from_us}

    def latestOffset(self) -> dict:
        closed = self._closed()
        return {"time_us": max(self.from_us, closed[-1][0] + 1 if closed else 0)}

    def partitions(self, start: dict, end: dict) -> Sequence[Folders]:
        names = [name for taken, name in self._closed() if start["time_us"] <= taken < end["time_us"]]
        return [Folders(names)] if names else []

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        taken = [int(name[len(TAKEN) :]) for name in partition.names]
        names = [f"{self.path}/{name}" for name in partition.names]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(taken, pa.int64())], ["folder", "taken_us"])


@dataclass(frozen=True)
class Feed:
    """A stream of recorder folders, and the event time from which on their messages count."""

    folders: DataFrame
    start_us: int | None

    def messages(self, batch: DataFrame) -> DataFrame:
        """Decoded messages of the folders in a micro-batch; the driver gets the names of the folders."""
        spark = batch.sparkSession
        names = sorted(row.folder for row in batch.select("folder").collect())
        text = spark.read.text(names) if names else spark.createDataFrame([], "value STRING")
        messages = parse_messages(text)
        return messages if self.start_us is None else from_cursor(messages, self.start_us)


def next_folder_us(spark: SparkSession, path: str) -> int:
    """The closing time from which on folders are new."""
    taken = [int(name[len(TAKEN) :]) for name in folders_in(spark, path) if name.startswith(TAKEN)]
    return max(taken, default=-1) + 1


def kept_start(spark: SparkSession, folder: str, path: str, start_us: int | None = None) -> tuple[int, int | None]:
    """The start of a stream, settled once: first folder to take and first event time.

    With a cursor (``start_us``) these follow from it. Without one, or with 0, the stream begins behind the folders
    that there are, and takes later ones whole. Later runs with the same ``folder`` get the first answer, whatever
    they pass, so a stream that goes on with its checkpoint leaves out nothing that came late or while it was down.
    """
    first = max(start_us - SKEW_US, 0) if start_us else next_folder_us(spark, path)
    kind = "from_us BIGINT, start_us BIGINT"
    spark.createDataFrame([(first, start_us or None)], kind).write.mode("ignore").json(folder)
    row = spark.read.schema(kind).json(folder).first()
    return row.from_us, row.start_us


def stream_feed(spark: SparkSession, path: str, state: str, start_us: int | None = None) -> Feed:
    """The recorded feed at ``path`` from a cursor on, or without one the latest; ``state`` keeps the start."""
    spark.dataSource.register(RecordedFolders)
    whole = qualified(spark, path)
    from_us, start = kept_start(spark, state, whole, start_us)
    folders = spark.readStream.format("recorded_folders").options(path=whole, from_us=str(from_us)).load()
    return Feed(folders, start)


def read_messages(spark: SparkSession, path: str, start_us: int | None = None) -> DataFrame:
    """Recorded messages as a batch; only folders that can hold messages from ``start_us`` on are read."""
    text = spark.read.text(path)
    if start_us:
        text = text.where(F.col("taken_us").cast("bigint") >= start_us - SKEW_US)
    messages = parse_messages(text.drop("taken_us"))
    return from_cursor(messages, start_us) if start_us else messages
