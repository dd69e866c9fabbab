"""Vector code compression: codebooks by part, distances looked up in dictionaries of each dimension's values."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget, integer_vectors, stored

#: Vectors in a block (its dictionaries hold no more values a dimension), and vectors whose distances are held at once.
ROWS, CHUNK = 4096, 512
#: Labels up to which their sums are broadcast; joined by hash beyond.
BROADCAST_ROWS = 1_000_000
BLOCK = "n int, ids binary, sizes binary, entries binary, codes binary"


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label (as text), v: integers floor(1024 * x) of the rows that take part."""
    return integer_vectors(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding"))


class Block:
    """Vectors as codes into dictionaries: for each dimension its distinct integers, ascending, and each vector's place there."""

    def __init__(self, values: list[np.ndarray], codes: np.ndarray):
        self.values, self.codes = values, codes

    @classmethod
    def of(cls, v: np.ndarray) -> Block:
        pairs = [np.unique(column, return_inverse=True) for column in v.T]
        return cls([a for a, _ in pairs], np.stack([b for _, b in pairs]).astype(np.uint16))

    @classmethod
    def read(cls, n: int, sizes: bytes, entries: bytes, codes: bytes) -> Block:
        cuts = np.cumsum(np.frombuffer(sizes, np.int32))[:-1]
        return cls(np.split(np.frombuffer(entries, np.int64), cuts), np.frombuffer(codes, np.uint16).reshape(-1, n))

    def parts(self) -> tuple[bytes, bytes, bytes]:
        return np.array([len(x) for x in self.values], np.int32).tobytes(), np.concatenate(self.values).tobytes(), self.codes.tobytes()

    def nearest(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part's codebook (parts, entries, width), ties to the lower index, and its squared distance: two arrays (parts, n)."""
        parts, k, width = books.shape
        n = self.codes.shape[1]
        best, least = np.zeros((parts, n), np.int64), np.zeros((parts, n), np.int64)
        top = 2 * max(int(np.abs(books).max()), *(int(np.abs(x).max()) for x in self.values))
        kind = np.int32 if top * top * width < 2**31 else np.int64
        for p in range(parts):
            # The table of a dimension: squared differences of each of its distinct integers to all entries.
            tables = [np.square(self.values[d][:, None] - books[p, :, d - p * width]).astype(kind) for d in range(p * width, (p + 1) * width)]
            for a in range(0, n, CHUNK):
                at = slice(a, min(a + CHUNK, n))
                sums = tables[0][self.codes[p * width, at]]
                for j in range(1, width):
                    sums += tables[j][self.codes[p * width + j, at]]
                best[p, at] = sums.argmin(axis=1)
                least[p, at] = np.take_along_axis(sums, best[p, at, None], axis=1)[:, 0]
        return best, least

    def totals(self, best: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """How many vectors took each entry, (parts, k), and the sums of their parts, (parts, k, width)."""
        parts = len(best)
        width = len(self.values) // parts
        counts = np.stack([np.bincount(b, minlength=k) for b in best])
        sums = np.zeros((parts, k, width), np.int64)
        for p in range(parts):
            for j in range(width):
                d = p * width + j
                np.add.at(sums[p, :, j], best[p], self.values[d][self.codes[d]])
        return counts, sums


def blocks(rows: DataFrame, dims: int) -> DataFrame:
    """Rows of whole_vectors() packed into blocks; ids holds vec_id and label as an Arrow stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                lengths = np.asarray(pa.compute.list_value_length(part.column(2)))
                if (lengths != dims).any():
                    raise ValueError(f"a vector has {lengths[lengths != dims][0]} components, the first one has {dims}")
                own = Block.of(np.asarray(part.column(2).flatten()).reshape(-1, dims))
                sink = pa.BufferOutputStream()
                ids = pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["vec_id", "label"])
                with pa.ipc.new_stream(sink, ids.schema) as out:
                    out.write_batch(ids)
                yield pa.RecordBatch.from_arrays([pa.array([part.num_rows], pa.int32()), *(pa.array([x], pa.binary()) for x in (sink.getvalue().to_pybytes(), *own.parts()))], names=["n", "ids", "sizes", "entries", "codes"])

    return rows.mapInArrow(run, BLOCK)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, Block]]:
    for batch in batches:
        for i in range(batch.num_rows):
            n, ids, *rest = (c[i].as_py() for c in batch.columns)
            yield ids, Block.read(n, *rest)


def refined(packed: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round. A task sends one sum a component of an entry, whatever its number of vectors."""
    parts, k, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, k, width + 1), np.int64)
        for _, block in _opened(batches):
            counts, sums = block.totals(block.nearest(books)[0], k)
            totals[:, :, 0] += counts
            totals[:, :, 1:] += sums
        used = np.flatnonzero(np.repeat(totals[:, :, 0].ravel() > 0, width + 1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals.ravel()[used])], names=["at", "total"])

    flat = np.zeros(parts * k * (width + 1), np.int64)
    for r in packed.mapInArrow(run, "at long, total long").groupBy("at").agg(F.sum("total").alias("total")).collect():  # parts * k * (width + 1) rows at most
        flat[r.at] = r.total
    totals = flat.reshape(parts, k, width + 1)
    counts = totals[:, :, :1]
    return np.where(counts > 0, totals[:, :, 1:] // np.maximum(counts, 1), books)


def coded(packed: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code, error of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in _opened(batches):
            best, least = block.nearest(books)
            rows = pa.ipc.open_stream(ids).read_all().combine_chunks()
            code = [x.tobytes().hex() for x in best.T.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([rows.column(0).combine_chunks(), rows.column(1).combine_chunks(), pa.array(code), pa.array(least.sum(axis=0))], names=["vec_id", "label", "code", "error"])

    return packed.mapInArrow(run, "vec_id long, label string, code string, error long")


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector.

    vectors: vec_id, embedding, label; other columns are ignored. Components count as floor(1024 * x). Rows with a
    null or empty vector, or with null or non-finite components, take no part. Vectors are cut into equal consecutive
    parts (1 to 256 entries each). A part's codebook starts as that part of the entries smallest vec_ids, ascending, null ids last, equal
    ids by their vectors; fewer rows: fewer entries. Each round assigns every part to its nearest entry (squared
    Euclidean distance, ties to the lower index) and moves each used entry to the floor of its parts' mean. error: the
    final squared distances of a vector; label_error: their sum over equal labels, nulls together. Repeated rows: a row
    each. No rows: no rows. Vectors of different lengths, or of one that parts does not divide, and components of 65,536
    or more either way, are an error.

    Vectors are written once as blocks of dictionary codes; every pass reads these. Only the codebooks (entries times
    dimensions) pass through the driver. A common label costs a task one partial sum.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code holds one byte a part: 1 to 256 entries")
    rows = whole_vectors(vectors)
    first = [r.v for r in rows.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(entries).collect()]  # entries rows at most
    spark = vectors.sparkSession
    if not first:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    dims = len(first[0])
    if dims % parts or any(len(v) != dims for v in first):
        raise ValueError(f"vectors must have one length, divisible by {parts}")
    packed = stored(blocks(rows, dims), "vector-blocks")
    books = np.array(first, np.int64).reshape(len(first), parts, dims // parts).transpose(1, 0, 2)
    for _ in range(rounds):
        books = refined(packed, books)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    out = stored(coded(packed, books), "vector-codes")
    forget(packed)
    sums = out.groupBy(F.col("label").alias("label_")).agg(F.sum("error").alias("label_error"))
    if sums.count() <= BROADCAST_ROWS:
        sums = F.broadcast(sums)
    return out.join(sums, F.col("label").eqNullSafe(F.col("label_"))).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """DuckDB SQL of compress() over embeddings."""
    distance = "CAST(list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    ctes = [
        "k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"p AS MATERIALIZED (SELECT vec_id, label, i AS part, list_slice(e, CAST(i * len(e) // {parts} + 1 AS BIGINT), CAST((i + 1) * len(e) // {parts} AS BIGINT)) AS v FROM k, range({parts}) t(i))",
        f"b0 AS MATERIALIZED (SELECT part, n - 1 AS entry, v FROM (SELECT part, v, row_number() OVER (PARTITION BY part ORDER BY vec_id) AS n FROM p) WHERE n <= {entries})",
    ]
    for i in range(rounds + 1):
        ctes.append(f"a{i} AS MATERIALIZED (SELECT vec_id, label, part, any_value(pv) AS v, min(d * 256 + entry) % 256 AS entry, min(d) AS d FROM (SELECT p.vec_id, p.label, p.part, p.v AS pv, b.entry, {distance} AS d FROM p JOIN b{i} AS b ON p.part = b.part) GROUP BY ALL)".replace("GROUP BY ALL", "GROUP BY vec_id, label, part"))
        if i < rounds:
            ctes.append(f"m{i} AS (SELECT part, entry, list(x ORDER BY j) AS v FROM (SELECT part, entry, j, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS j FROM a{i}) GROUP BY part, entry, j) GROUP BY part, entry)")
            ctes.append(f"b{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{i} AS b LEFT JOIN m{i} AS m ON b.part = m.part AND b.entry = m.entry)")
    last = rounds
    ctes.append(f"r AS (SELECT vec_id, label, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{last} GROUP BY vec_id, label)")
    ctes.append(f"h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{last})")
    return f"WITH {', '.join(ctes)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM r, h"


ORACLE_SQL = _sql()
