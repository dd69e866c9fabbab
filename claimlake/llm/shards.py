"""Training-order materialisation: a keyed Feistel permutation with cycle-walking gives every sequence a global slot."""

from __future__ import annotations

import posixpath
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget, mixed, once, shared_dir, slices, stored
from .tokenizers_io import WordBpe

SEQUENCES = "part int, nth long, ids binary"
MANIFEST = "shard long, file string, first_slot long, n_sequences long, n_bytes long, crc32 long"


class Feistel:
    """A keyed bijection of 0..n-1: four rounds over the least even number of bits that holds n, walked until the value is under n."""

    def __init__(self, n: int, key: int, rounds: int = 4):
        self.n = n
        self.half = np.uint64(max(1, -(-max(1, n - 1).bit_length() // 2)))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = mixed(np.arange(1, rounds + 1, dtype=np.uint64) + np.uint64(key))

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in self.keys:
            left, right = right, left ^ (mixed(right + k) & self.mask)
        return left << self.half | right

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in self.keys[::-1]:
            left, right = right ^ (mixed(left + k) & self.mask), left
        return left << self.half | right

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        out = step(x.astype(np.uint64))
        while len(far := np.flatnonzero(out >= self.n)):
            out[far] = step(out[far])
        return out.astype(np.int64)

    def slot(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, self._once)

    def index(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, self._back)


def sequences(docs: DataFrame, path: str, end_id: int, window: int) -> DataFrame:
    """part, nth, ids: the ids of a partition's documents, each with end_id, one after another in windows of 16-bit ids; its last window may be shorter."""
    rows = docs.select(F.spark_partition_id().alias("part"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = once(("word-bpe", path), lambda: WordBpe(path))
        end, step, nth, rest, part = np.array([end_id], bpe.dtype).tobytes(), 2 * window, 0, b"", None

        def cut(raw: bytes) -> pa.RecordBatch:
            windows = [raw[a : a + step] for a in range(0, len(raw), step)]
            return pa.RecordBatch.from_arrays([pa.array([part] * len(windows), pa.int32()), pa.array(range(nth, nth + len(windows)), pa.int64()), pa.array(windows, pa.binary())], names=["part", "nth", "ids"])

        for big in batches:
            for batch in slices(big, "text", 4 << 20):
                part = batch.column(0)[0].as_py()
                raw = rest + b"".join(bpe.encode(t.encode()) + end for t in batch.column(1).to_pylist())
                bpe.trim()
                full = len(raw) // step * step
                yield cut(raw[:full])
                nth, rest = nth + full // step, raw[full:]
        if rest:
            yield cut(rest)

    return rows.mapInArrow(run, SEQUENCES)


def slotted(docs: DataFrame, path: str, key: int, end_id: int = 2, window: int = 1024) -> tuple[DataFrame, DataFrame, int]:
    """slot and ids of all sequences(), the slots a permutation of 0..n-1; the table that they are read from; n."""
    cut = stored(sequences(docs, path, end_id, window), "sequences")
    sizes = cut.groupBy("part").agg(F.max("nth").alias("most")).collect()  # a row for each input partition: bounded by the number of tasks
    bases, n = [], 0
    for r in sorted(sizes, key=lambda r: r.part):
        bases.append((r.part, n))
        n += r.most + 1
    base = docs.sparkSession.createDataFrame(bases, "part int, base long")
    feistel = Feistel(n, key)

    @F.pandas_udf("long")
    def slot(index):
        return index.__class__(feistel.slot(index.to_numpy()))

    return cut.join(F.broadcast(base), "part").select(slot(F.col("base") + F.col("nth")).alias("slot"), "ids"), cut, n


def read(out: str, n: int, start: int = 0, window: int = 1024, per_shard: int = 2048) -> Iterator[tuple[int, np.ndarray]]:
    """(slot, ids) of the n sequences of a folder of shards in training order from slot start on: a reader that stopped goes on where it was with one seek."""
    fs, root = pyarrow.fs.FileSystem.from_uri(out)
    stride = 2 * window
    while start < n:
        shard, nth = divmod(start, per_shard)
        with fs.open_input_file(posixpath.join(root, _named(shard))) as f:
            f.seek(stride * nth)
            for slot in range(start, min(n, (shard + 1) * per_shard)):
                yield slot, np.frombuffer(f.read(stride), "<u2")
        start = (shard + 1) * per_shard


def _named(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def write(docs: DataFrame, path: str, out: str | None = None, key: int = 2024, end_id: int = 2, window: int = 1024, per_shard: int = 2048) -> DataFrame:
    """Writes all sequences in training order to shards of fixed stride, and returns a row for each shard.

    docs: doc_id, text; other columns are ignored. Documents, each followed by end_id, fill windows one after another,
    so only the last window of an input partition holds padding. Window i, in the order of partitions, gets slot
    Feistel(n, key).slot(i); how the input is split decides which window is which. Slot s is record s % per_shard of
    shard s // per_shard: window ids of 16 bits, little-endian, padded with zeros, so read() resumes at byte
    2 * window * (s % per_shard). Partitions are ranges of slots, cut between shards; every shard is one file, written
    whole by one task under another name and then renamed, and a task that is tried again writes the same bytes. Null
    or empty text: end_id alone. Null doc_id and repeated rows: like any other. No rows: no shards. Slots spread hot
    sources and long texts evenly over all shards.
    """
    spark = docs.sparkSession
    rows, cut, n = slotted(docs, path, key, end_id, window)
    out = out or f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    stride = 2 * window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(out)
        fs.create_dir(root, recursive=True)
        shard, first, count, crc, sink, temp = None, 0, 0, 0, None, ""

        def finish():
            sink.close()
            name = _named(shard)
            fs.move(temp, posixpath.join(root, name))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((shard, pa.int64()), (name, pa.string()), (first, pa.int64()), (count, pa.int64()), (count * stride, pa.int64()), (crc, pa.int64()))], names=["shard", "file", "first_slot", "n_sequences", "n_bytes", "crc32"])

        for batch in batches:
            for slot, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if slot // per_shard != shard:
                    if sink:
                        yield finish()
                    shard, first, count, crc = slot // per_shard, slot, 0, 0
                    temp = posixpath.join(root, f".{uuid.uuid4().hex}")
                    sink = fs.open_output_stream(temp)
                record = ids.ljust(stride, b"\0")
                sink.write(record)
                count, crc = count + 1, zlib.crc32(record, crc)
        if sink:
            yield finish()

    shards = max(1, -(-n // per_shard))
    tasks = min(shards, max(1, spark.sparkContext.defaultParallelism * 4, shards // 64))
    to = F.expr(f"cast(slot div {per_shard} * {tasks} div {shards} as int)")
    dealt = rows.repartitionById(tasks, to).sortWithinPartitions("slot")
    manifest = stored(dealt.mapInArrow(run, MANIFEST), "manifest")
    forget(cut)
    return manifest
