"""Byte-level BPE by two-tier lookup: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Memo, once, slices
from .tokenizers_io import SpacedChunks, read_ranks

ENCODED = "doc_id long, ids binary, n_tokens long"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PerfectHash:
    """Keys to 0..n-1 without gaps or collisions.

    Keys fall into small buckets. Each bucket of two or more, largest first, gets the first displacement that sends
    all its keys to free slots; a bucket of one is given a free slot itself.
    """

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.buckets = max(1, self.n // 4)
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for h in map(xxhash.xxh3_64_intdigest, keys):
            members[h % self.buckets].append(h)
        self.shift = [0] * self.buckets
        taken = bytearray(self.n)
        order = sorted(range(self.buckets), key=lambda b: -len(members[b]))
        for b in order:
            if len(members[b]) < 2:
                break
            d = 1
            while len({*(slots := [self._slot(h, d) for h in members[b]])}) < len(slots) or any(taken[s] for s in slots):
                d += 1
            self.shift[b] = d
            for s in slots:
                taken[s] = 1
        free = (s for s in range(self.n) if not taken[s])
        for b in order:
            if len(members[b]) == 1:
                self.shift[b] = -next(free)

    def _slot(self, h: int, d: int) -> int:
        x = ((h ^ d * 0x9E3779B97F4A7C15) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        return ((x ^ x >> 29) * 0x94D049BB133111EB >> 32 & 0xFFFFFFFF) % self.n

    def slot(self, key: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        return self._slot(h, d) if d > 0 else -d


class Codec:
    """Encodes and decodes by a rank file; ids are the ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, perfect: PerfectHash | None = None):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.hash = perfect or PerfectHash(list(ranks))
        self.keys: list[bytes] = [b""] * len(ranks)
        self.ids = [0] * len(ranks)
        for key, rank in ranks.items():
            s = self.hash.slot(key)
            self.keys[s], self.ids[s] = key, rank
        self.spelled = {rank: key for key, rank in ranks.items()}
        self.pretokens = Memo(self._pretoken)
        self.chunks = Memo(self._chunk)

    def _pretoken(self, piece: bytes) -> bytes:
        s = self.hash.slot(piece)
        if self.keys[s] == piece:
            return self.ids[s].to_bytes(4, "little")
        return np.array(self.merge(piece), "<u4").tobytes()

    def merge(self, piece: bytes) -> list[int]:
        """Lowest rank first, leftmost first: a heap of neighbouring pairs over a doubly linked list of parts."""
        ranks, n = self.ranks, len(piece)
        stop, left, right = [*range(1, n + 1)], [*range(-1, n - 1)], [*range(1, n + 1)]
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapify(heap)
        alive = bytearray(b"\1" * n)
        while heap:
            _, i, end = heappop(heap)
            j = right[i]
            if not alive[i] or j >= n or stop[j] != end:
                continue  # one of the two has grown or gone since
            stop[i], right[i], alive[j] = end, right[j], 0
            if (k := right[i]) < n:
                left[k] = i
                if (r := ranks.get(piece[i : stop[k]])) is not None:
                    heappush(heap, (r, i, stop[k]))
            if (k := left[i]) >= 0 and (r := ranks.get(piece[k:end])) is not None:
                heappush(heap, (r, k, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : stop[i]]])
            i = right[i]
        return out

    def _chunk(self, chunk: str) -> bytes:
        text = SpacedChunks.whole(chunk)
        head, text = (self.pretokens[b"\n"], text[1:]) if text[0] == "\n" else (b"", text)
        return head + self._whole(text)

    def _whole(self, text: str) -> bytes:
        return b"".join(self.pretokens[p.encode()] for p in self.pattern.findall(text))

    def encode(self, text: str) -> bytes:
        """ids of a text as little-endian unsigned 32-bit integers."""
        cut = SpacedChunks.cut(text)
        return self._whole(text) if cut is None else b"".join(map(self.chunks.__getitem__, cut))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.spelled.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def trim(self) -> None:
        self.pretokens.trim()
        self.chunks.trim()


def _mapped(docs: DataFrame, path: str, pattern: str, schema: str, columns) -> DataFrame:
    ranks = read_ranks(path)
    shared = docs.sparkSession.sparkContext.broadcast((ranks, PerfectHash(list(ranks))))  # bounded by the vocabulary
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = once(("bpe", "codec", path, pattern), lambda: Codec(shared.value[0], pattern, shared.value[1]))
        for big in batches:
            for batch in slices(big, "text", 4 << 20):
                yield columns(codec, batch)
                codec.trim()

    return rows.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit, binary) and n_tokens of every whole text.

    docs: doc_id, text; other columns are ignored. path: a rank file; pattern: what cuts texts into pre-tokens. Null
    or empty text: no ids. Null doc_id and repeated rows: a row each. No shuffle.
    """

    def columns(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [codec.encode(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())], names=["doc_id", "ids", "n_tokens"])

    return _mapped(docs, path, pattern, ENCODED, columns)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the bytes that ids stand for; null ids: null. An id outside the vocabulary is an error."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = once(("bpe", "spelled", path), lambda: {r: k for k, r in ranks.value.items()})
        for batch in batches:
            raw = [None if x is None else b"".join(map(spelled.__getitem__, np.frombuffer(x, "<u4").tolist())) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["doc_id", "raw"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, raw binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """encode(), then decode, in one pass: doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text; rules as for encode()."""

    def columns(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        n, a, b = [], [], []
        for t in batch.column(1).to_pylist():
            ids = codec.encode(t)
            n.append(len(ids) // 4)
            a.append(hashlib.sha256(ids).hexdigest())
            b.append(hashlib.sha256(codec.decode(ids)).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _mapped(docs, path, pattern, DIGESTS, columns)
