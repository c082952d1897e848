"""User-defined stream sources, read in partitions on the executors.

A source numbers what it has. The driver only moves offsets: it asks how far the source has
come and cuts what is new into splits. Each split is read by a task, as Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows in a batch made from single rows.
BATCH_ROWS = 10_000


class EventFeed:
    """A replayable event source: subclass it and register it with :func:`register_feed`.

    ``latest`` gives the offset reached; it runs in the driver. Either ``rows`` gives the
    rows between two offsets one by one, or ``batches`` gives those of a split as Arrow
    batches; both run on executors and must give the same rows for the same offsets, so that
    a failed micro-batch can be read again.
    """

    schema = "user string, url string, ts_ms bigint"
    #: Into how many splits new offsets are cut.
    parts = 4

    def __init__(self, options: dict[str, str]):
        self.options = options

    def latest(self) -> int:
        raise NotImplementedError

    def rows(self, start: int, stop: int) -> Iterator[tuple]:
        raise NotImplementedError

    def splits(self, start: int, stop: int) -> list[Any]:
        """What tasks read: by default, ranges of offsets of about one size."""
        cuts = [start + (stop - start) * i // self.parts for i in range(self.parts + 1)]
        return [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]

    def batches(self, split: Any, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for row in self.rows(*split):
            held.append(row)
            if len(held) == BATCH_ROWS:
                yield _batch(held, schema)
                held = []
        if held:
            yield _batch(held, schema)


class FilesFeed(EventFeed):
    """Parquet files of a folder that are only ever added, in the order of their names.

    Options: ``path`` and ``schema``. The offset is a number of files, and each file a split. Any
    file system that Arrow knows will do.
    """

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.schema = options["schema"]

    def _folder(self) -> tuple[pa.fs.FileSystem, str]:
        return pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", self.options["path"]))

    def _files(self) -> list[str]:
        files, folder = self._folder()
        found = files.get_file_info(pa.fs.FileSelector(folder, recursive=True))
        return sorted(f.path for f in found if f.is_file and f.path.endswith(".parquet"))

    def latest(self) -> int:
        return len(self._files())

    def splits(self, start: int, stop: int) -> list[str]:
        return self._files()[start:stop]

    def batches(self, split: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        files, _ = self._folder()
        with files.open_input_file(split) as file:
            for batch in pa.parquet.ParquetFile(file).iter_batches(BATCH_ROWS, columns=schema.names):
                columns = [batch.column(f.name).cast(f.type) for f in schema]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


@dataclass
class _Split(InputPartition):
    held: Any

    def __init__(self, held: Any):
        super().__init__(held)
        self.held = held


class _FeedReader(DataSourceStreamReader):
    def __init__(self, feed: EventFeed, schema: StructType):
        self.feed, self.schema = feed, to_arrow_schema(schema)

    def initialOffset(self) -> dict:
        return {"offset": 0}

    def latestOffset(self) -> dict:
        return {"offset": self.feed.latest()}

    def partitions(self, start: dict, end: dict) -> list[_Split]:
        return [_Split(s) for s in self.feed.splits(start["offset"], end["offset"])]

    def read(self, partition: _Split) -> Iterator[pa.RecordBatch]:
        return self.feed.batches(partition.held, self.schema)

    def commit(self, end: dict) -> None:
        pass


def register_feed(spark: SparkSession, feed: type[EventFeed], name: str) -> None:
    """Make ``spark.readStream.format(name)`` read the feed."""

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return feed(dict(self.options)).schema

        def streamReader(self, schema) -> _FeedReader:
            return _FeedReader(feed(dict(self.options)), schema)

    spark.dataSource.register(Source)
