"""A log of commits beside a table: numbered JSON files that say what counts.

A writer puts its files into a folder of its own and then adds one commit that names it. Readers go by the commits
and never list the data. A commit is a file that appears whole under the next free number; a writer that
finds the number taken looks at the newer state and tries again, so a stream and a compaction can
work side by side. The driver reads and writes a few kilobytes per commit; the latest number stands in a hint, from
which a reader goes on, so the log is not listed either.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LOG = "_log"
HINT = "_hint"


class CommitLog:
    """The commits of the table at ``path``; each is a dict of JSON values with its number as ``version``."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = f"{path.rstrip('/')}/{LOG}"
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._place(self.path).getFileSystem(self._conf)

    def _place(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _of(self, version: int):
        return self._place(f"{self.path}/{version:012d}.json")

    def _text(self, place) -> str:
        stream = self._files.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put(self, place, text: str) -> None:
        stream = self._files.create(place, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def ensure(self) -> str:
        """Make the folder of the log, so that a stream can wait for its first commit."""
        self._files.mkdirs(self._place(self.path))
        return self.path

    def last_version(self) -> int:
        """Number of the newest commit; -1 for none."""
        hint = self._place(f"{self.path}/{HINT}")
        version = -1
        if self._files.exists(hint):
            # A hint that is being rewritten may be empty.
            version = int(self._text(hint) or -1)
        while self._files.exists(self._of(version + 1)):
            version += 1
        return version

    def read(self, version: int) -> dict:
        return json.loads(self._text(self._of(version)))

    def latest(self) -> dict:
        """The newest commit, or an empty dict."""
        version = self.last_version()
        return self.read(version) if version >= 0 else {}

    def commit(self, change: Callable[[dict], dict | None]) -> dict:
        """Add ``change(newest commit)``; nothing is added if that is None. Returns the commit that then counts."""
        names = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self._conf)
        no_overwrite = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        while True:
            version = self.last_version()
            before = self.read(version) if version >= 0 else {}
            after = change(dict(before))
            if after is None:
                return before
            after["version"] = version + 1
            draft = self._place(f"{self.path}/_draft-{uuid.uuid4().hex}")
            self._put(draft, json.dumps(after) + "\n")
            try:
                names.rename(self._files.makeQualified(draft), self._files.makeQualified(self._of(version + 1)), no_overwrite)
            except Py4JJavaError as error:
                self._files.delete(draft, False)
                if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                    raise
                continue
            self._put(self._place(f"{self.path}/{HINT}"), str(version + 1))
            return after


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``, sorted; none if it is missing."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place) if status.isDirectory())
