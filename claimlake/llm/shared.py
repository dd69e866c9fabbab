"""What the operators of this subpackage share: written tables, memos, byte buffers."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; where that is unset, a folder of our own in local mode and an error elsewhere."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


#: Integers at or beyond this, either way, are an error: sums of squares and products over a vector would leave 64 bits.
WIDEST = 1 << 26


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """The rows of vectors whose embedding is neither null nor empty and has only finite components, with v: integers floor(1024 * x) in its place. Components of WIDEST / 1024 or more, either way, are an error."""
    rows = vectors.withColumn("embedding", F.col("embedding").cast("array<double>")).filter("size(embedding) > 0")
    rows = rows.filter(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    wide = F.exists("embedding", lambda x: F.abs(x) >= WIDEST / 1024)
    checked = F.when(wide, F.raise_error(F.lit(f"a component of {WIDEST // 1024} or more is out of range"))).otherwise(F.col("embedding"))
    return rows.withColumn("v", F.transform(checked, lambda x: F.floor(x * 1024).cast("long"))).drop("embedding")


def forget(*tables: DataFrame | None) -> None:
    """Deletes what stored() wrote for these tables; nothing that is still to run may read them."""
    for df in tables:
        if df is not None and (path := df.__dict__.pop("stored_at", None)):
            sc = df.sparkSession.sparkContext
            at = sc._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


class Memo(dict):
    """A bounded memo of a pure function: m[key] computes what is missing; trim() after each batch."""

    def __init__(self, compute, limit: int = 250_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        value = self[key] = self.compute(key)
        return value

    def trim(self) -> None:
        if len(self) > self.limit:
            self.clear()


_SINGLETONS: dict = {}


def once(key, make):
    """make() once for each Python worker and key, so that memos outlive a task; what other operators made, told by key[0], goes."""
    if key not in _SINGLETONS:
        for other in [k for k in _SINGLETONS if k[0] != key[0]]:
            del _SINGLETONS[other]
        _SINGLETONS[key] = make()
    return _SINGLETONS[key]


def slices(batch: pa.RecordBatch, column: str, most_bytes: int):
    """Pieces of a batch with about most_bytes of the text column each, one row at least."""
    col = batch.column(batch.schema.get_field_index(column))
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0), dtype=np.int64)
    ends, at = np.cumsum(lengths), 0
    while at < len(lengths):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most_bytes, "right")))
        yield batch.slice(at, to - at)
        at = to


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another, and len + 1 offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    values = pa.compute.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, values.offset * 8)
    data = values.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


#: The bytes that part words: space and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_MULTIPLIER = 0x9E3779B97F4A7C15
_LETTERS = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}
#: Powers that a worker keeps; for a longer text they are made anew.
KEPT_POWERS = 1 << 21


def _powers(n: int) -> tuple[np.ndarray, ...]:
    """Powers of the multiplier and of its inverse mod 2**64, n of each."""
    out = []
    for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 2**64)):
        powers = _POWERS.get(base, ())
        if len(powers) < n:
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            powers = np.cumprod(steps)
            if len(powers) <= KEPT_POWERS:
                _POWERS[base] = powers
        out.append(powers[:n])
    return tuple(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end]: equal bytes, equal hash, whatever stands around them."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[data] * up[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def runs_of(solid: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text number of the longest stretches of bytes marked in solid, of texts held as by buffers()."""
    if not len(solid):
        return (np.zeros(0, np.int64),) * 3
    cuts = offsets[(offsets > 0) & (offsets < len(solid))]
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    start[cuts] = solid[cuts]
    end[cuts - 1] = solid[cuts - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text number of the words [^\\x20\\x09-\\x0D]+ of texts held as by buffers()."""
    return runs_of(~SPACE[data], offsets)


def per_text(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Sums of values by text number, n of them."""
    return np.bincount(text, weights=values, minlength=n).astype(np.int64) if len(text) else np.zeros(n, np.int64)
