"""A user's own source, as a Spark streaming data source.

A ``Feed`` says how many positions there are and reads any range of them. ``FeedSource`` makes a
stream of it: offsets are positions, kept by Spark in the query's checkpoint; each micro-batch's
range is cut into partitions that executors read on their own; after a failure Spark asks for the
same range again, so nothing is lost or repeated. A feed must give the same rows for a range
whenever it is asked, and may grow at its end.

``ParquetFeed`` is the feed of a table's rows in file order.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "riverbend_feed"
ROWS_PER_PARTITION = 100_000


class Feed:
    """What a user writes: made from the reader's options on the driver and on every executor."""

    def __init__(self, options: dict[str, str]):
        self.options = options

    def end(self) -> int:
        """The position after the last row there is now; never falls."""
        raise NotImplementedError

    def read(self, start: int, end: int, columns: list[str]) -> Iterator[pa.RecordBatch]:
        """The rows at positions ``start`` to ``end - 1``."""
        raise NotImplementedError


class ParquetFeed(Feed):
    """Rows of the Parquet file or folder ``path``, files by name: new files must sort after the
    old ones. Only the row groups and columns asked for are read."""

    def _files(self) -> tuple[pafs.FileSystem, list[str]]:
        fs, root = pafs.FileSystem.from_uri(self.options["path"])
        if fs.get_file_info(root).type == pafs.FileType.File:
            return fs, [root]
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        return fs, sorted(f.path for f in found if f.base_name.endswith(".parquet"))

    def end(self) -> int:
        fs, files = self._files()
        return sum(pq.ParquetFile(fs.open_input_file(f)).metadata.num_rows for f in files)

    def read(self, start: int, end: int, columns: list[str]) -> Iterator[pa.RecordBatch]:
        fs, files = self._files()
        at = 0
        for name in files:
            if at >= end:
                return
            with fs.open_input_file(name) as handle:
                file = pq.ParquetFile(handle)
                for g in range(file.num_row_groups):
                    rows = file.metadata.row_group(g).num_rows
                    low, high = max(start, at), min(end, at + rows)
                    if low < high:
                        yield from file.read_row_group(g, columns).slice(low - at, high - low).to_batches()
                    at += rows


class Range(InputPartition):
    def __init__(self, start: int, end: int):
        super().__init__((start, end))


class FeedReader(DataSourceStreamReader):
    """Offsets are ``{"at": position}``.

    ``rowsPerBatch`` bounds a micro-batch. Spark does not tell a reader where a restarted query
    stands, so the last offset that was handed out is kept in the file ``progress`` (on shared
    storage): the next one is never before it. Without the option a micro-batch is all there is.
    """

    def __init__(self, feed: Feed, schema: StructType):
        self.feed, self.columns = feed, schema.fieldNames()
        self.step = int(feed.options.get("rowsperbatch", 0))
        self.progress = feed.options.get("progress")
        if self.step and not self.progress:
            raise ValueError("rowsPerBatch needs the option progress, a file on shared storage")

    def initialOffset(self) -> dict:
        return {"at": 0}

    def latestOffset(self) -> dict:
        end = self.feed.end()
        if not self.step:
            return {"at": end}
        fs, path = pafs.FileSystem.from_uri(self.progress)
        before = 0
        if fs.get_file_info(path).type == pafs.FileType.File:
            with fs.open_input_stream(path) as f:
                before = json.loads(f.read())["at"]
        now = max(before, min(end, before + self.step))
        if now != before:
            with fs.open_output_stream(f"{path}.new") as f:
                f.write(json.dumps({"at": now}).encode())
            fs.move(f"{path}.new", path)
        return {"at": now}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        size = int(self.feed.options.get("rowsperpartition", ROWS_PER_PARTITION))
        return [Range(a, min(a + size, end["at"])) for a in range(start["at"], end["at"], size)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        start, end = partition.value
        yield from self.feed.read(start, end, self.columns)

    def commit(self, end: dict) -> None:
        """Nothing to free: the feed keeps its rows."""


class FeedSource(DataSource):
    """``spark.readStream.format("riverbend_feed")`` with the options ``feed`` (``module:class``),
    ``rowsPerBatch`` with ``progress``, ``rowsPerPartition``, and those of the feed."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        raise ValueError("name the columns: .schema(...)")

    def streamReader(self, schema: StructType) -> FeedReader:
        options = {k.lower(): v for k, v in self.options.items()}
        module, _, name = options["feed"].partition(":")
        return FeedReader(getattr(importlib.import_module(module), name)(options), schema)


def read_feed(spark: SparkSession, feed: type[Feed], schema: StructType | str, **options) -> DataFrame:
    """A stream of the rows of ``feed``, a class that executors can import."""
    spark.dataSource.register(FeedSource)
    return (spark.readStream.format(FORMAT).schema(schema).option("feed", f"{feed.__module__}:{feed.__qualname__}")
            .options(**{k: str(v) for k, v in options.items()}).load())
