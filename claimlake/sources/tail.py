"""A growing folder of line files as a stream: offsets are bytes of each file, and only lines that have ended are handed out."""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes that one task reads, that one batch takes of a file, and that are looked at in one go for the end of a line.
SPLIT, MOST, STEP = 32 << 20, 1 << 30, 1 << 20


@dataclass
class Span(InputPartition):
    """The lines of a file that begin in [start, stop); first: the batch's own start in the file, which a line begins at."""

    path: str
    first: int
    start: int
    stop: int
    last: int


def _ended(stream, low: int, high: int) -> int:
    """The end of the last line that ends in [low, high), or low."""
    while high > low:
        at = max(low, high - STEP)
        stream.seek(at)
        cut = stream.read(high - at).rfind(b"\n")
        if cut >= 0:
            return at + cut + 1
        high = at
    return low


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, most: int):
        self.store, self.root = fs.FileSystem.from_uri(path)
        self.most = most
        self.now: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        out = dict(self.now)
        for info in self.store.get_file_info(fs.FileSelector(self.root, recursive=True, allow_not_found=True)):
            before = out.get(info.path, 0)
            if info.type == fs.FileType.File and not info.base_name.startswith((".", "_")) and info.size > before:
                with self.store.open_input_file(info.path) as stream:
                    end = _ended(stream, before, min(info.size, before + self.most))
                    if end == before and info.size > before + self.most:  # a line longer than a batch
                        end = _ended(stream, before, info.size)
                out[info.path] = end
        self.now = {k: v for k, v in out.items() if v}
        return {"files": json.dumps(self.now, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        before, after = json.loads(start["files"]), json.loads(end["files"])
        self.now = {k: max(v, self.now.get(k, 0)) for k, v in (self.now | after).items()}
        out = []
        for path, last in after.items():
            first = before.get(path, 0)
            out += [Span(path, first, at, min(at + SPLIT, last), last) for at in range(first, last, SPLIT)]
        return out

    def read(self, span: Span) -> Iterator[pa.RecordBatch]:
        with io.BufferedReader(self.store.open_input_file(span.path), STEP) as stream:
            at = span.start
            if at > span.first:  # the line that runs into this span belongs to the one before
                stream.seek(at - 1)
                at = at - 1 + len(stream.readline())
            stream.seek(at)
            lines, places, size = [], [], 0
            while at < span.stop:
                line = stream.readline()
                if not line:
                    break
                lines.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
                places.append(at)
                at += len(line)
                size += len(line)
                if size >= STEP:
                    yield self._batch(span.path, places, lines)
                    lines, places, size = [], [], 0
            if lines:
                yield self._batch(span.path, places, lines)

    @staticmethod
    def _batch(path: str, places: list[int], lines: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path] * len(lines)), pa.array(places, pa.int64()), pa.array(lines)], names=["file", "at", "value"])

    def commit(self, end: dict) -> None:
        pass


class LineTail(DataSource):
    """Format "lines_tail": file, at (byte where the line begins), value of every ended line below the path, each once.

    Files that appear and files that grow are followed; a last line without a line feed waits until it has one. A file
    that shrank is left as it is until it has outgrown what was read of it. Names that begin with a point or an
    underscore are passed over. Bytes that are no UTF-8 are replaced.
    """

    @classmethod
    def name(cls) -> str:
        return "lines_tail"

    def schema(self) -> str:
        return "file string, at long, value string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options["path"], int(self.options.get("maxBytesPerFile", MOST)))


def followed(spark: SparkSession, path: str, most: int = MOST) -> DataFrame:
    """The stream of a folder's ended lines. path: an absolute path or a URI that every executor can open."""
    spark.dataSource.register(LineTail)
    return spark.readStream.format("lines_tail").option("maxBytesPerFile", most).load(path)
