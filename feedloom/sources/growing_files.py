"""Stream source for folders of hour files that are still being appended to.

Spark's own file source reads a file once and does not notice that it grew. This source plans which bytes are new;
whole closed files are then read by Spark's text scan, and only the new end of a file that grew by a task of its own.

An offset holds positions for the files of running days: the two latest days by name, and every day with an open file
(``.part``). Of any other day it holds one mark, a digest of the names and sizes of its files. A day whose mark differs is
read again from its start, whatever the times of its files say: the merge of posts takes repeated lines without effect, so
a file that comes late, or is restored with an old time or one ahead of time, costs its day but is never lost. Positions of
running days stand behind the last line end, so a half-written line waits for its rest.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from feedloom.session import qualified
from feedloom.sources.files import file_system
from feedloom.sources.hour_files import HOUR_PATH, LINES, day_of_name, hour_lines, hour_of

READ_BYTES = 4 * 1024 * 1024
TAIL_BYTES = 64 * 1024
OPENERS = 16
RUNNING_DAYS = 2


@dataclass
class Piece(InputPartition):
    """Bytes of a file that are new; ``size`` and ``changed`` as the driver saw them."""

    path: str
    start: int
    stop: int
    size: int
    changed: int


@dataclass
class Pieces(InputPartition):
    pieces: list[Piece]


class GrowingFiles(DataSource):
    """New bytes of the hour files below ``path``."""

    @classmethod
    def name(cls) -> str:
        return "growing_files"

    def schema(self) -> str:
        return "file_path STRING, start BIGINT, stop BIGINT, size BIGINT, file_time BIGINT"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return GrowingFilesReader(self.options["path"])


class GrowingFilesReader(DataSourceStreamReader):
    """Offsets are ``{"files": {path: position}, "days": {day: mark}}``."""

    def __init__(self, path: str):
        self.path = path
        self.ends: dict[str, tuple[int, int]] = {}

    def _listed(self) -> dict[str, list[tuple[str, int, int]]]:
        """Path below the root, size and time of the hour files of each day."""
        files, root = file_system(self.path)
        days: dict[str, list[tuple[str, int, int]]] = {}
        for info in files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            found = re.search(HOUR_PATH, info.path)
            if info.type == fs.FileType.File and found and not info.base_name.startswith(("_", ".")):
                name = info.path[len(root.rstrip("/")) :]
                days.setdefault(found[1][:10], []).append((name, info.size, (info.mtime_ns or 0) // 1_000))
        return {day: sorted(entries) for day, entries in sorted(days.items())}

    def initialOffset(self) -> dict:
        return {"files": {}, "days": {}}

    def latestOffset(self) -> dict:
        days = self._listed()
        running = set(list(days)[-RUNNING_DAYS:])
        running |= {day for day, entries in days.items() if any(path.endswith(".part") for path, _, _ in entries)}
        live = [entry for day in sorted(running) for entry in days[day]]
        # Only files whose size changed since the last look are opened.
        grown = [(path, size) for path, size, _ in live if self.ends.get(path, (-1, 0))[0] != size]
        files, root = file_system(self.path)
        with ThreadPoolExecutor(OPENERS) as pool:
            ends = list(pool.map(lambda entry: _last_line_end(files, root + entry[0], entry[1]), grown))
        self.ends = {path: self.ends[path] for path, _, _ in live if path in self.ends}
        self.ends |= {path: (size, end) for (path, size), end in zip(grown, ends) if end is not None}
        return {
            "files": {path: self.ends[path][1] for path, _, _ in live if path in self.ends},
            "days": {day: _mark(entries) for day, entries in days.items() if day not in running},
        }

    def partitions(self, start: dict, end: dict) -> Sequence[Pieces]:
        pieces = []
        for day, entries in self._listed().items():
            for path, size, changed in entries:
                if day in end["days"]:
                    # A day that ends keeps what was read of it; the last line of a file may lack its end.
                    if start["days"].get(day) == end["days"][day]:
                        continue
                    stop = size
                elif path in end["files"]:
                    stop = end["files"][path]
                else:
                    continue  # came after the offset was made
                begin = start["files"].get(path, 0)
                if stop < begin:  # a shorter file under the same name is a new file
                    begin = 0
                if begin < stop:
                    pieces.append(Piece(path, begin, stop, size, changed))
        return [Pieces(pieces)] if pieces else []

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        rows = [(p.path, p.start, p.stop, p.size, p.changed) for p in partition.pieces]
        names = ["file_path", "start", "stop", "size", "file_time"]
        yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*rows)], names)


def _mark(entries: list[tuple[str, int, int]]) -> str:
    """Digest of names and sizes."""
    return hashlib.md5("\n".join(f"{path}\t{size}" for path, size, _ in entries).encode()).hexdigest()


def _last_line_end(files: fs.FileSystem, path: str, size: int) -> int | None:
    """Position behind the last line end, read back from the end of the file; None if the file is gone."""
    try:
        stream = files.open_input_file(path)
    except FileNotFoundError:
        return None
    with stream:
        stop = size
        while stop > 0:
            start = max(0, stop - TAIL_BYTES)
            stream.seek(start)
            found = stream.read(stop - start).rfind(b"\n")
            if found >= 0:
                return start + found + 1
            stop = start
    return 0


def new_lines(files: fs.FileSystem, path: str, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """Lines between two positions, with their own; a file that is gone has none."""
    try:
        stream = files.open_input_file(path)
    except FileNotFoundError:
        return  # An open file that was closed meanwhile: its lines come with the closed file, which is new.
    with stream:
        stream.seek(start)
        position, carry = start, b""
        while block := stream.read(min(READ_BYTES, max(stop - position - len(carry), 0))):
            *lines, carry = (carry + block).split(b"\n")
            for line in lines:
                yield position, line
                position += len(line) + 1
        yield position, carry


def _tails(place: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = file_system(place)
        for batch in batches:
            for path, start, stop, _, changed in zip(*batch.to_pydict().values()):
                rows: list[tuple] = []
                held = 0
                for position, line in new_lines(files, root + path, start, stop):
                    if line:
                        rows.append((line.decode("utf-8", "replace"), place + path, changed, position))
                        held += len(line)
                    if held > READ_BYTES:
                        yield _rows(rows)
                        rows, held = [], 0
                if rows:
                    yield _rows(rows)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column) for column in zip(*rows)], ["value", "file_path", "file_time", "block_start"]
    )


@dataclass(frozen=True)
class Growing:
    """A stream of new pieces of files, and how those of a micro-batch are read."""

    pieces: DataFrame
    path: str

    def lines(self, batch: DataFrame) -> DataFrame:
        """Lines of the pieces; the driver gets their names and positions."""
        spark = batch.sparkSession
        rows = batch.collect()
        at = F.lit(rows[0].indexed_at if rows else None).cast("bigint")
        lines = spark.createDataFrame([], f"{LINES}, file_day STRING")
        whole = [row.file_path for row in rows if row.start == 0 and row.stop == row.size and not row.file_path.endswith(".part")]
        if whole:
            lines = lines.unionByName(hour_lines(spark.read.text([self.path + path for path in whole])))
        tails = [tuple(row)[:5] for row in rows if row.file_path not in set(whole)]
        if tails:
            shape = "file_path STRING, start BIGINT, stop BIGINT, size BIGINT, file_time BIGINT"
            found = spark.createDataFrame(tails, shape).repartition(len(tails)).mapInArrow(
                _tails(self.path), "value STRING, file_path STRING, file_time BIGINT, block_start BIGINT"
            )
            hour = hour_of(F.col("file_path"))
            lines = lines.unionByName(found.withColumns({"hour": hour, "file_day": day_of_name(hour)}))
        return lines.withColumn("indexed_at", at)


def stream_growing(spark: SparkSession, path: str) -> Growing:
    """Lines of growing hour files as they come, in the shape of ``hour_files.stream_lines``."""
    spark.dataSource.register(GrowingFiles)
    whole = qualified(spark, path).rstrip("/")
    pieces = spark.readStream.format("growing_files").options(path=whole).load()
    return Growing(pieces.withColumn("indexed_at", F.unix_micros(F.current_timestamp())), whole)
