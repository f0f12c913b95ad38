"""A log of records in partitions with offsets, as a Spark data source for batch and stream.

A write stages one file for each task and partition of the log, and publishes all of them by one
small commit file, which says where in the log each staged file stands. Files of tasks that
failed or ran twice are in no commit, so a record is published once or not at all, and
every published record has a partition and an offset. Readers look at commits only; a
stream keeps the next offset of each partition, so it can be stopped, resumed and replayed.

One writer at a time may publish to a log. The folder is read and written by the workers
themselves, so it has to be a path that pyarrow knows (a mount, hdfs, s3, gs).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

SCHEMA = "partition int, offset bigint, key binary, value binary, timestamp timestamp"
_STORED = pa.schema([("key", pa.binary()), ("value", pa.binary()),
                     ("timestamp", pa.timestamp("us", tz="UTC"))])
_READ = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), *_STORED])


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    if ":" not in path:
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


@dataclass(frozen=True)
class StagedFile:
    """Records of one partition that a task has written; order is the task's place in the job."""

    partition: int
    order: int
    name: str
    rows: int


@dataclass
class Staged(WriterCommitMessage):
    files: list[StagedFile]


class Commits:
    """The published files of a log.

    A commit has `begins` and `ends` (next offset of each partition before and after it) and
    `files` (name, partition, first offset, rows).
    """

    def __init__(self, path: str) -> None:
        self._files, self._root = _filesystem(path)

    def _numbers(self) -> list[int]:
        found = self._files.get_file_info(
            fs.FileSelector(f"{self._root}/commits", allow_not_found=True))
        return sorted(int(info.base_name.removesuffix(".json")) for info in found
                      if info.base_name.endswith(".json") and not info.base_name.startswith("."))

    def _read(self, number: int) -> dict:
        with self._files.open_input_file(f"{self._root}/commits/{number:012d}.json") as source:
            return json.loads(source.read())

    def ends(self) -> dict[int, int]:
        numbers = self._numbers()
        known = self._read(numbers[-1])["ends"] if numbers else {}
        return {int(partition): end for partition, end in known.items()}

    def publish(self, staged: list[StagedFile]) -> None:
        """Give offsets to staged files, by partition and order, in one atomic step."""
        numbers, begins, files = self._numbers(), self.ends(), []
        ends = dict(begins)
        for file in sorted(staged, key=lambda file: (file.partition, file.order)):
            first = ends.get(file.partition, 0)
            files.append([file.name, file.partition, first, file.rows])
            ends[file.partition] = first + file.rows
        number = numbers[-1] + 1 if numbers else 0
        folder = f"{self._root}/commits"
        self._files.create_dir(folder, recursive=True)
        draft = f"{folder}/.{uuid.uuid4().hex}"
        with self._files.open_output_stream(draft) as out:
            out.write(json.dumps({"begins": begins, "ends": ends, "files": files}).encode())
        self._files.move(draft, f"{folder}/{number:012d}.json")

    def slices(self, start: dict[int, int], end: dict[int, int]) -> list[Slice]:
        """The parts of files that hold the offsets from `start` to before `end`."""
        found = []
        for number in reversed(self._numbers()):
            commit = self._read(number)
            for name, partition, first, rows in commit["files"]:
                low = max(start.get(partition, 0), first)
                high = min(end.get(partition, 0), first + rows)
                if low < high:
                    found.append(Slice(name, partition, first, low - first, high - first))
            begins = {int(partition): first for partition, first in commit["begins"].items()}
            if all(begins.get(partition, 0) <= start.get(partition, 0) for partition in end):
                break  # earlier commits hold earlier offsets only
        return found[::-1]


class Slice(InputPartition):
    """Rows `low` to before `high` of a file whose first record has the offset `first`."""

    def __init__(self, name: str, partition: int, first: int, low: int, high: int) -> None:
        self.name, self.partition, self.first, self.low, self.high = (
            name, partition, first, low, high)

    def read(self, path: str) -> Iterator[pa.RecordBatch]:
        files, root = _filesystem(path)
        with files.open_input_file(f"{root}/data/{self.name}") as source:
            file, at = pq.ParquetFile(source), 0
            for group in range(file.num_row_groups):
                rows = file.metadata.row_group(group).num_rows
                if at < self.high and at + rows > self.low:
                    for batch in file.iter_batches(row_groups=[group]):
                        low, high = max(self.low, at), min(self.high, at + batch.num_rows)
                        if low < high:
                            yield self._placed(batch.slice(low - at, high - low), low)
                        at += batch.num_rows
                else:
                    at += rows

    def _placed(self, batch: pa.RecordBatch, row: int) -> pa.RecordBatch:
        offsets = range(self.first + row, self.first + row + batch.num_rows)
        partition = pa.array([self.partition] * batch.num_rows, pa.int32())
        return pa.RecordBatch.from_arrays(
            [partition, pa.array(offsets, pa.int64()), *batch.columns], schema=_READ)


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str) -> None:
        self._path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        files, root = _filesystem(self._path)
        files.create_dir(f"{root}/data", recursive=True)
        order, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        writers: dict[int, pq.ParquetWriter] = {}
        rows: dict[int, int] = {}
        try:
            for batch in iterator:
                table = pa.Table.from_batches([batch])
                for partition in table["partition"].unique().to_pylist():
                    own = table.filter(pa.compute.equal(table["partition"], partition))
                    if partition not in writers:
                        name = f"{root}/data/{order}-{partition}-{attempt}.parquet"
                        writers[partition] = pq.ParquetWriter(
                            files.open_output_stream(name), _STORED)
                        rows[partition] = 0
                    writers[partition].write_table(own.select(_STORED.names).cast(_STORED))
                    rows[partition] += own.num_rows
        finally:
            for writer in writers.values():
                writer.close()
        return Staged([
            StagedFile(partition, order, f"{order}-{partition}-{attempt}.parquet", count)
            for partition, count in rows.items()])

    def commit(self, messages: list[Staged | None]) -> None:
        staged = [file for message in messages if message for file in message.files]
        if staged:
            Commits(self._path).publish(staged)

    def abort(self, messages: list[Staged | None]) -> None:
        files, root = _filesystem(self._path)
        for message in messages:
            for file in message.files if message else []:
                files.delete_file(f"{root}/data/{file.name}")


class _Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self._path = path

    def partitions(self) -> Sequence[Slice]:
        commits = Commits(self._path)
        return commits.slices({}, commits.ends())

    def read(self, partition: Slice | None) -> Iterator[pa.RecordBatch]:
        # an empty log has one partition of nothing
        return partition.read(self._path) if partition else iter([])


def _offsets(known: dict) -> dict[int, int]:
    return {int(partition): offset for partition, offset in known.items()}


class _StreamReader(DataSourceStreamReader):
    """Offsets are the next one of each partition, as JSON has them (partitions as text)."""

    def __init__(self, path: str, starting: str, most: int | None) -> None:
        self._path, self._starting, self._most = path, starting, most
        self._seen: dict[int, int] = {}

    def initialOffset(self) -> dict:  # noqa: N802
        if self._starting == "latest":
            self._seen = Commits(self._path).ends()
        elif self._starting != "earliest":
            self._seen = _offsets(json.loads(self._starting))
        return {str(partition): offset for partition, offset in self._seen.items()}

    def latestOffset(self) -> dict:  # noqa: N802
        ends = Commits(self._path).ends()
        if self._most is not None:
            ends = {partition: min(end, self._seen.get(partition, 0) + self._most)
                    for partition, end in ends.items()}
        return {str(partition): offset for partition, offset in ends.items()}

    def partitions(self, start: dict, end: dict) -> Sequence[Slice]:
        # on a restart this is called for an empty range, which tells where the stream stands
        self._seen = _offsets(end)
        return Commits(self._path).slices(_offsets(start), self._seen)

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return partition.read(self._path)


class RecordLog(DataSource):
    """Format `recordlog`; options: path, for a stream also startingOffsets (`latest`, the
    default, `earliest`, or the next offsets as JSON) and maxRecordsPerPartition of a batch."""

    @classmethod
    def name(cls) -> str:
        return "recordlog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"])

    def streamReader(self, schema) -> _StreamReader:  # noqa: N802
        most = self.options.get("maxRecordsPerPartition")
        return _StreamReader(self.options["path"], self.options.get("startingOffsets", "latest"),
                             None if most is None else int(most))

    def writer(self, schema, overwrite: bool) -> _Writer:
        if overwrite:
            raise ValueError("records are appended to a log, not overwritten")
        return _Writer(self.options["path"])


def publish(df: DataFrame, path: str, partition: Column, order: list[str]) -> dict[int, range]:
    """Append the records (key, value, timestamp) and return the offsets they got.

    Within a partition offsets follow `order`, whose columns should tell records apart. The
    records are sorted in ranges, so a partition with most of the records is written by
    many tasks. A write that fails publishes nothing and can be repeated.
    """
    spark = df.sparkSession
    spark.dataSource.register(RecordLog)
    before = Commits(path).ends()
    rows = df.withColumn("partition", partition.cast("int")).repartitionByRange(
        "partition", *order).sortWithinPartitions("partition", *order)
    rows.select(
        "partition", F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
    ).write.format("recordlog").option("path", path).mode("append").save()
    after = Commits(path).ends()
    return {partition: range(before.get(partition, 0), end) for partition, end in after.items()
            if end > before.get(partition, 0)}


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every published record with its partition and offset."""
    spark.dataSource.register(RecordLog)
    return spark.read.format("recordlog").option("path", path).load()


def record_stream(
    spark: SparkSession, path: str, starting: str = "latest", most: int | None = None,
) -> DataFrame:
    """The log as a stream; `most` bounds the records of a partition in one batch."""
    spark.dataSource.register(RecordLog)
    reader = spark.readStream.format("recordlog").option("path", path)
    if most is not None:
        reader = reader.option("maxRecordsPerPartition", most)
    return reader.option("startingOffsets", starting).load()
