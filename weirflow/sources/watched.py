"""Stream sources over a path whose place survives a restart: it is the offset of the stream, kept in its checkpoint.

``weirflow_follow`` gives the whole content of a path as lines each time it has changed; its offset is the stamp (name, time, size) of
the files. ``weirflow_new_files`` gives the rows of Parquet files; its offset is the newest file taken, fixed by the first batch even
if that is empty, so ``latest`` means the start of the first run. Files must appear in the order of their times.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

RANGE_BYTES = 64 << 20
READ_BYTES = 4 << 20


@dataclass
class _Range(InputPartition):
    path: str
    start: int = 0
    end: int = 0


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri("file:///" + path[6:].lstrip("/") if path.startswith("file:/") else path)


def _files(path: str) -> list[tuple[int, str, int]]:
    """Time, name and size of the files at ``path``, oldest first; none if there is nothing yet. Hidden files and markers are left out."""
    store, name = _opened(path)
    info = store.get_file_info(name)
    if info.type == fs.FileType.NotFound:
        return []
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(name))
    return sorted((f.mtime_ns, f.path, f.size) for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._")


class _FollowReader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {"files": "[]"}

    def latestOffset(self) -> dict:
        return {"files": json.dumps(_files(self.path))}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if start == end:
            return []
        files = json.loads(end["files"])
        return [_Range(name, a, min(a + RANGE_BYTES, size)) for _, name, size in files for a in range(0, size, RANGE_BYTES)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        """Lines that begin in the range; a range before the end of the file reads its last line to the line's end."""
        store, _ = _opened(self.path)
        with store.open_input_file(partition.path) as f:
            size, at = f.size(), partition.start
            if at:  # the line that reaches into the range belongs to the one before
                f.seek(at - 1)
                while at < size:
                    block = f.read(READ_BYTES)
                    cut = block.find(b"\n")
                    if cut >= 0 or not block:
                        at += max(cut, 0)
                        break
                    at += len(block)
            f.seek(at)
            rest = b""
            while at < min(partition.end, size):
                block = f.read(min(READ_BYTES, partition.end - at))
                at += len(block)
                *lines, rest = (rest + block).split(b"\n")
                if lines:
                    yield _lines(lines)
            while rest and at < size:
                block = f.read(READ_BYTES)
                at += len(block)
                cut = block.find(b"\n")
                rest += block if cut < 0 else block[:cut]
                if cut >= 0 or not block:
                    break
            if rest:
                yield _lines([rest])


def _lines(lines: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines], pa.string())], names=["value"])


class FollowSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "weirflow_follow"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _FollowReader(self.options["path"])


class _NewFilesReader(DataSourceStreamReader):
    def __init__(self, path: str, start: str, schema: StructType):
        self.path, self.start, self.schema = path, start, to_arrow_schema(schema)

    def initialOffset(self) -> dict:
        return self.latestOffset() if self.start == "latest" else {"time": 0, "name": ""}

    def latestOffset(self) -> dict:
        files = _files(self.path)
        return {"time": files[-1][0], "name": files[-1][1]} if files else {"time": 0, "name": ""}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        low, high = (start["time"], start["name"]), (end["time"], end["name"])
        return [_Range(name) for time, name, _ in _files(self.path) if low < (time, name) <= high]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        store, _ = _opened(self.path)
        with store.open_input_file(partition.path) as f:
            for batch in pq.ParquetFile(f, coerce_int96_timestamp_unit="us").iter_batches(columns=self.schema.names):
                yield from pa.Table.from_batches([batch]).select(self.schema.names).cast(self.schema).to_batches()


class NewFilesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "weirflow_new_files"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _NewFilesReader(self.options["path"], self.options.get("start", "earliest"), schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FollowSource)
    spark.dataSource.register(NewFilesSource)
