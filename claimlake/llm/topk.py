"""Exact top-k by inner product with vector-approximation files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import forget, integer_vectors, stored

#: Vectors in a block, cells of each dimension (half a byte), queries that are worked on at once.
ROWS, CELLS, CHUNK = 4096, 16, 512
#: Vectors and queries of a task's part of the grid; one block in SAMPLE is searched first, for the bounds that the others start from.
PART, BATCH, SAMPLE = 1 << 18, 1 << 16, 16
BLOCK = "dim int, n int, ids binary, edges binary, cells binary, width int, vectors binary"
QUERY = "query_id long, q_dim int, vector binary"
RANKED = "query_id long, vec_id long, score long"
_NONE = np.iinfo(np.int64).min


def _narrow(whole: np.ndarray) -> np.ndarray:
    """Integers in the fewest bytes of each that hold them all."""
    for kind in (np.int16, np.int32):
        if np.abs(whole).max(initial=0) <= np.iinfo(kind).max:
            return whole.astype(kind)
    return whole


class ApproximationFile:
    """A block's vectors as half a byte a component, and the exact integers, which are read only where the cells leave doubt.

    A dimension's cells are equally wide, so what a cell adds to a score is linear in its number: one product of the
    queries with the cells looks up the bounds of all pairs at once.
    """

    def __init__(self, ids: np.ndarray, edges: np.ndarray, packed: np.ndarray, exact: np.ndarray):
        self.ids, self.packed, self.exact = ids, packed, exact
        self.low, self.step = edges

    @classmethod
    def of(cls, ids: np.ndarray, whole: np.ndarray) -> ApproximationFile:
        low, high = whole.min(axis=0), whole.max(axis=0)
        step = np.maximum(1, -(-(high - low + 1) // CELLS))
        cells = ((whole - low) // step).astype(np.uint8)
        cells = np.pad(cells, ((0, 0), (0, cells.shape[1] % 2)))
        return cls(ids, np.stack([low, step]), cells[:, ::2] | cells[:, 1::2] << 4, _narrow(whole))

    def row(self) -> pa.RecordBatch:
        values = (self.exact.shape[1], len(self.ids), self.ids.tobytes(), np.stack([self.low, self.step]).tobytes(), self.packed.tobytes(), self.exact.itemsize, self.exact.tobytes())
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=[c.split()[0] for c in BLOCK.split(", ")])

    @classmethod
    def read(cls, dim: int, n: int, ids: bytes, edges: bytes, cells: bytes, width: int, vectors: bytes) -> ApproximationFile:
        return cls(np.frombuffer(ids, np.int64), np.frombuffer(edges, np.int64).reshape(2, dim), np.frombuffer(cells, np.uint8).reshape(n, -1), np.frombuffer(vectors, f"<i{width}").reshape(n, dim))

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the most that each pair of a query and a vector can score, (queries, vectors)."""
        dim = len(self.low)
        cells = np.empty((len(self.ids), 2 * self.packed.shape[1]))
        cells[:, ::2], cells[:, 1::2] = self.packed & 15, self.packed >> 4
        q, low, step = queries.astype(np.float64), self.low.astype(np.float64), self.step.astype(np.float64)
        middle = q @ low
        # rounding of sums beyond 2**53
        slack = np.abs(q) @ (np.abs(low) + CELLS * step) * dim * 2.0**-52
        slack[slack < 0.25] = 0
        sums = (q * step) @ cells[:, :dim].T
        least = sums + (middle + np.minimum(q, 0) @ (step - 1) - slack)[:, None]
        most = sums + (middle + np.maximum(q, 0) @ (step - 1) + slack)[:, None]
        return least, most


class Best:
    """The k best of each query so far: scores falling, ties to smaller ids; none is kept that scores less than its floor."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int):
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.floors = floors.copy()
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in query_ids]

    def search(self, file: ApproximationFile) -> int:
        """Takes in a block; how many exact vectors it read."""
        least, most = file.bounds(self.queries)
        read, k = 0, self.k
        for i, own in enumerate(self.query_ids):
            other = file.ids != own
            if len(file.ids) > k:
                lows = least[i][other]
                if len(lows) >= k:
                    self.floors[i] = max(self.floors[i], int(np.ceil(np.partition(lows, -k)[-k])))
            near = np.flatnonzero(other & (most[i] >= self.floors[i]))
            near = near[np.argsort(-most[i][near], kind="stable")]
            at = 0
            while at < len(near) and most[i][near[at]] >= self.floors[i]:
                some = near[at : at + 64]
                at += 64
                scores = file.exact[some].astype(np.int64) @ self.queries[i]
                keep = scores >= self.floors[i]
                scores, ids = np.concatenate([self.found[i][0], scores[keep]]), np.concatenate([self.found[i][1], file.ids[some][keep]])
                best = np.lexsort((ids, -scores))[:k]
                self.found[i] = scores[best], ids[best]
                if len(best) == k:
                    self.floors[i] = max(self.floors[i], int(scores[best[-1]]))
            read += min(at, len(near))
        return read

    def rows(self) -> pa.RecordBatch:
        n = [len(s) for s, _ in self.found]
        columns = [np.repeat(self.query_ids, n), np.concatenate([i for _, i in self.found]), np.concatenate([s for s, _ in self.found])]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["query_id", "vec_id", "score"])


def files(rows: DataFrame) -> DataFrame:
    """Rows (vec_id, v) as approximation files of up to ROWS vectors of one dimension each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1)
            flat, at = np.asarray(v.flatten()), np.concatenate([[0], np.cumsum(np.asarray(pa.compute.list_value_length(v)))])
            ids, dims = np.asarray(batch.column(0)), np.diff(at)
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                for i in range(0, len(own), ROWS):
                    part = own[i : i + ROWS]
                    yield ApproximationFile.of(ids[part], flat[at[part][:, None] + np.arange(d)]).row()

    return rows.mapInArrow(run, BLOCK)


def _query_rows(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1)
            flat, at = np.asarray(v.flatten()), np.concatenate([[0], np.cumsum(np.asarray(pa.compute.list_value_length(v)))])
            raw = [flat[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at), pa.int32()), pa.array(raw, pa.binary())], names=["query_id", "q_dim", "vector"])

    return rows.mapInArrow(run, QUERY)


def searched(blocks: DataFrame, queries: DataFrame, parts: int, batches: int, k: int) -> DataFrame:
    """query_id, vec_id, score: the k best rows of each part of the blocks for each query (query_id, q_dim, vector, floor), those under its floor left out.

    Parts of blocks and batches of queries make a grid; a task owns a cell of it, and its bounds pass from block to
    block.
    """
    each = F.sequence(F.lit(0), F.lit(batches - 1))
    left = blocks.withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int")).withColumn("batch", F.explode(each))
    right = queries.withColumn("batch", F.pmod(F.xxhash64("query_id"), F.lit(batches)).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def cell(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = [pa.RecordBatch.from_pylist([], pa.schema([(c, pa.int64()) for c in ("query_id", "vec_id", "score")]))]
        names = [c.split()[0] for c in BLOCK.split(", ")]
        held = [ApproximationFile.read(*(rows[c][i].as_py() for c in names)) for i in range(rows.num_rows)]
        dims = np.asarray(asked["q_dim"].combine_chunks())
        for d in np.unique(dims):
            own = asked.take(pa.array(np.flatnonzero(dims == d)))
            ids, floors = (np.asarray(own[c].combine_chunks()) for c in ("query_id", "floor"))
            vectors = np.frombuffer(b"".join(own["vector"].to_pylist()), np.int64).reshape(-1, d)
            for at in range(0, len(ids), CHUNK):
                to = slice(at, at + CHUNK)
                best = Best(ids[to], vectors[to], floors[to], k)
                for file in held:
                    if file.exact.shape[1] == d:
                        best.search(file)
                out.append(best.rows())
        return pa.Table.from_batches(out)

    return left.groupBy("part", "batch").cogroup(right.groupBy("part", "batch")).applyInArrow(cell, RANKED)


def top_k(vectors: DataFrame, every: int = 100, k: int = 10, part: int = PART, batch: int = BATCH) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each row whose vec_id is divisible by every.

    vectors: vec_id, embedding; other columns are ignored. Components count as floor(1024 * x); one of 65,536 or more
    either way is an error, so that no score can leave 64 bits. Rows with a null id, a null vector, or null or
    non-finite components take no part; empty vectors neither. Only vectors of the query's dimension are candidates. A
    repeated row is a candidate for each time it stands, but never for its own id; its queries are one. Fewer than k
    candidates: all. Ties to the smaller vec_id.

    Vectors are written once as approximation files. One file in SAMPLE is searched first: the kth score there is each
    query's floor for all others, so that a query's final ranking reads about SAMPLE times k rows, however many files
    there are.
    """
    spark = vectors.sparkSession
    whole = integer_vectors(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter("vec_id IS NOT NULL"))
    blocks = stored(files(whole.select("vec_id", "v")), "approximation-files")
    queries = stored(_query_rows(whole.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))), "queries")
    n, asked = blocks.agg(F.sum("n"), F.count(F.lit(1))).first(), queries.count()
    if not n[0] or not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    parts = max(min(n[1], int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-n[0] // part))
    batches = -(-asked // batch)
    first = F.pmod(F.xxhash64("ids", F.lit(1)), F.lit(SAMPLE)) == 0
    none = F.lit(_NONE).cast("long")
    sample = stored(searched(blocks.filter(first), queries.withColumn("floor", none), parts, batches, k), "sample")
    at = sample.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") == k)
    floors = queries.join(at.select("query_id", F.col("score").alias("floor")), "query_id", "left").withColumn("floor", F.coalesce("floor", none))
    both = sample.union(searched(blocks.filter(~first), floors, parts, batches, k))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    out = stored(both.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "top-k")
    forget(blocks, queries, sample)
    return out
