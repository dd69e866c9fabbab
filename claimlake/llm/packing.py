"""Mixture-controlled packing by deficit round-robin over source queues."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import once, slices, stored
from .tokenizers_io import WordBpe

#: Queues up to which every task gets the table of their totals; beyond, places come from a distributed sort. The places are the same.
MOST_QUEUES = 1024
#: Rounds whose table of queues is held at once, and grains of a queue that one task lists.
ROUNDS, GRAINS = 1024, 1 << 16
#: Rows of the table of queue offsets (one for each partition and queue) up to which it is broadcast.
BROADCAST_ROWS = 500_000

TOKENS = "doc_id long, queue string, part int, queued long, doc_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, queue string"


def queue_of(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s:"), source.cast("string")), F.lit("null"))


def tokenised(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Each document's ids and end_id, with its place in its partition's share of its queue.

    A queue is the documents of one source, in partition order; queued is the number of the queue's ids before the
    document within the partition.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), queue_of(F.col("source")).alias("queue"), F.spark_partition_id().alias("part"), F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = once(("word-bpe", path), lambda: WordBpe(path))
        end = np.array([end_id], bpe.dtype).tobytes()
        width, before = len(end), {}
        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                queues = batch.column(1).to_pylist()
                ids = [bpe.encode(t.encode()) + end for t in batch.column(3).to_pylist()]
                bpe.trim()
                counts, at = [len(x) // width for x in ids], []
                for q, n in zip(queues, counts, strict=True):
                    at.append(before.get(q, 0))
                    before[q] = at[-1] + n
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(at, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "queue", "part", "queued", "doc_tokens", "ids"])

    return rows.mapInArrow(encode, TOKENS)


def rounds(quantum: np.ndarray, last: np.ndarray, grain_no: np.ndarray, grain: int) -> np.ndarray:
    """The round in which a grain of a queue is served, from the queue's quantum and last round."""
    r = np.ceil(grain * (grain_no + 1) / quantum).astype(np.int64) - 1
    for _ in range(2):  # the division may be off by one
        r -= (r > 0) & (np.floor(r * quantum / grain) >= grain_no + 1)
        r += np.floor((r + 1) * quantum / grain) < grain_no + 1
    return np.minimum(r, last)


def sequence(all_: int, window: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence, offset in it, and its end in the stream. The rest after the last full one is cut into powers of two, so that nothing is padded."""
    full, rest = divmod(all_, window)
    parts = [1 << b for b in range(window.bit_length(), -1, -1) if rest >> b & 1]
    begins = full * window + np.cumsum([0, *parts])
    i = np.clip(np.searchsorted(begins, at, "right") - 1, 0, max(0, len(parts) - 1))
    tail = at >= full * window
    start = np.where(tail, begins[i], at // window * window)
    size = np.where(tail, np.array(parts or [1])[i], window)
    return np.where(tail, full + i, at // window), at - start, start + size

def quanta(total, given, whole: float, window: int):
    """What each round adds to a queue's credit, and the last round of the queue."""
    quantum = window * given / max(whole, 1e-300)
    return quantum, np.ceil(total / np.maximum(quantum, 1e-300)).astype(np.int64) - 1


class Schedule:
    """Deficit round-robin in closed form.

    In each round every queue's credit grows by its quantum, window * weight / sum of weights; a queue is served in
    whole grains of ids while its credit allows, and what is left of the credit, less than a grain, is its deficit,
    carried into the next round. So served(r), the ids that a queue has been served before round r, depends on r
    alone, and any task can place any id without walking through the rounds before it.
    """

    def __init__(self, totals: dict[str, int], weights: dict[str, float] | None, window: int, grain: int):
        self.names = sorted(totals)
        self.total = np.array([totals[q] for q in self.names], np.int64)
        given = np.array([float((weights or {}).get(q, 0.0)) for q in self.names]) if weights else self.total.astype(float)
        if weights:  # queues without a target share what one mean queue has
            given = np.where(given > 0, given, max(given.sum(), 1.0) / max(1, len(given)) / 100)
        self.quantum, self.last = quanta(self.total, given, given.sum(), window)
        self.window, self.grain = window, grain
        self.all = int(self.total.sum())

    def served(self, r: np.ndarray) -> np.ndarray:
        """Matrix of ids served before each round r (rows) from each queue (columns)."""
        credit = r[:, None] * self.quantum[None, :]
        return np.where(r[:, None] > self.last[None, :], self.total, np.minimum(self.total, (self.grain * np.floor(credit / self.grain)).astype(np.int64)))

    def rounds(self, queue: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The round in which the id at place x of a queue is served."""
        return rounds(self.quantum[queue], self.last[queue], x // self.grain, self.grain)

    def place(self, queue: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The place in the packed stream of the id at place x of a queue."""
        r = self.rounds(queue, x)
        some, back = np.unique(r, return_inverse=True)
        order = np.argsort(back, kind="stable")
        cuts = np.searchsorted(back[order], np.arange(0, len(some) + ROUNDS, ROUNDS))
        out = np.empty(len(x), np.int64)
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):  # a long text meets many rounds
            own, first = order[a:b], i * ROUNDS
            held = some[first : first + ROUNDS]
            now, then = self.served(held), self.served(held + 1)
            ahead = np.cumsum(then - now, axis=1) - (then - now)
            at = back[own] - first
            out[own] = now.sum(axis=1)[at] + ahead[at, queue[own]] + x[own] - now[at, queue[own]]
        return out

    def sequence(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return sequence(self.all, self.window, at)

    def pieces(self, queue: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Pieces of documents that begin at place first of their queue and have n ids: document, start, length, sequence, offset."""
        g0, g1 = first // self.grain, (first + n - 1) // self.grain
        many = g1 - g0 + 1
        doc = np.repeat(np.arange(len(n)), many)
        g = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + g0[doc]
        begin = np.maximum(g * self.grain, first[doc])
        end = np.minimum((g + 1) * self.grain, (first + n)[doc])
        at = self.place(queue[doc], begin)
        out = []
        while len(doc):  # cut at the ends of sequences
            seq, off, stop = self.sequence(at)
            size = np.minimum(end - begin, stop - at)
            out.append((doc, begin - first[doc], size, seq, off))
            more = begin + size < end
            doc, begin, end, at = doc[more], (begin + size)[more], end[more], (at + size)[more]
        doc, start, size, seq, off = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.lexsort((start, doc))
        doc, start, size, seq, off = (x[order] for x in (doc, start, size, seq, off))
        new = np.ones(len(doc), bool)  # join what stayed together
        new[1:] = (doc[1:] != doc[:-1]) | (seq[1:] != seq[:-1]) | (off[1:] != off[:-1] + size[:-1])
        heads = np.flatnonzero(new)
        return doc[heads], start[heads], np.add.reduceat(size, heads), seq[heads], off[heads]


def pack(docs: DataFrame, path: str, end_id: int = 2, window: int = 4096, grain: int = 256, weights: dict[str, float] | None = None) -> DataFrame:
    """Packs every document's ids into sequences of window ids that hold the sources in target token proportions.

    docs: doc_id, text, source; other columns are ignored. path: a word-end BPE file. weights: target proportion by
    source; None: each source's share of all ids, so that all queues end together. A window holds each source's
    quantum up to a grain; deficits pass from window to window and, as every place follows from counts alone, from
    partition to partition. Where a queue ends early, the others fill the windows in proportion to their weights.
    Sources without a target in weights get a hundredth of a mean target each. As whole grains are served, a source
    may stand up to a grain behind its target at any point: a window's proportions hold to a grain for each source,
    and with many sources only over so many windows as their grains fill. Within a queue documents come in the order of the input's partitions, so
    another split of the input gives another packing of the same proportions.

    Returns a row for each piece: doc_id, start and length in the document's ids, ids_crc32, doc_tokens, sequence_id,
    offset, queue. Null or empty text: end_id alone. Null source: a queue of its own. Null doc_id and repeated rows:
    packed like any other row. No rows: no pieces. Ids of one sequence are gapless from offset 0.

    Texts are encoded once and written with 16-bit ids; only counts by partition and queue are shuffled. The table of
    offsets is broadcast up to BROADCAST_ROWS rows and joined by key beyond. With more than MOST_QUEUES sources grains
    are placed by packed_by_sort(), at the same places.
    """
    if window & (window - 1) or grain > window:
        raise ValueError("window must be a power of two and grain no larger")
    tokens = stored(tokenised(docs, path, end_id), "tokens")
    counts = stored(tokens.groupBy("queue", "part").agg(F.sum("doc_tokens").alias("n")), "queues")
    totals = counts.groupBy("queue").agg(F.sum("n").alias("n"))
    few = totals.limit(MOST_QUEUES + 1).collect()
    goals = weights and {"s:" + k: v for k, v in weights.items()}
    w = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("queue", "part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("base"))
    if counts.count() <= BROADCAST_ROWS:
        bases = F.broadcast(bases)
    placed = tokens.join(bases, ["queue", "part"]).select("doc_id", "queue", (F.col("base") + F.col("queued")).alias("first"), "doc_tokens", "ids")
    if len(few) > MOST_QUEUES:
        return packed_by_sort(placed, stored(totals, "queue-totals"), goals, window, grain)
    plan = Schedule({r.queue: r.n for r in few}, goals, window, grain)
    number = {q: i for i, q in enumerate(plan.names)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "ids", 1 << 20):
                queue = np.array([number[q] for q in batch.column(1).to_pylist()])
                first, n = (np.asarray(batch.column(i)).astype(np.int64) for i in (2, 3))
                doc, start, size, seq, off = plan.pieces(queue, first, n)
                ids = [np.frombuffer(x.as_buffer(), "<u2").astype("<u4").tobytes() for x in batch.column(4)]
                sums = [zlib.crc32(memoryview(ids[d])[4 * a : 4 * (a + k)]) for d, a, k in zip(doc.tolist(), start.tolist(), size.tolist(), strict=True)]
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), pa.array(start), pa.array(size), pa.array(sums, pa.int64()), pa.array(n[doc]), pa.array(seq), pa.array(off), batch.column(1).take(take)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue"])

    return placed.mapInArrow(cut, PIECES)


def packed_by_sort(placed: DataFrame, totals: DataFrame, goals: dict[str, float] | None, window: int, grain: int) -> DataFrame:
    """The pieces of any number of queues: their grains are sorted by round and queue, sums of the sizes before them give their places, and documents meet these grain by grain.

    placed: doc_id, queue, first (place in the queue), doc_tokens, ids; totals: queue, n. A piece ends with its grain.
    """
    spark = placed.sparkSession
    sums = totals.agg(F.sum("n"), F.count(F.lit(1))).first()
    all_, queues = sums[0] or 0, sums[1]
    given = F.col("n").cast("double")
    whole = float(all_)
    if goals:
        named = spark.createDataFrame(list(goals.items()), "queue string, goal double")
        totals = totals.join(F.broadcast(named), "queue", "left").withColumn("goal", F.coalesce("goal", F.lit(0.0)))
        goal = totals.agg(F.sum("goal")).first()[0] or 0.0
        given = F.when(F.col("goal") > 0, F.col("goal")).otherwise(max(goal, 1.0) / max(1, queues) / 100)
        whole = totals.agg(F.sum(given)).first()[0] or 0.0
    chunks = F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {grain * GRAINS}"))
    listed = totals.withColumn("given", given).withColumn("chunk", F.explode(chunks)).select("queue", "n", "given", "chunk").repartition("queue", "chunk")

    def grains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                queue, n, g, chunk = (c[i].as_py() for c in batch.columns)
                quantum, last = quanta(np.array([n]), np.array([g]), whole, window)
                no = np.arange(chunk * GRAINS, min((chunk + 1) * GRAINS, -(-n // grain)))
                size = np.minimum(grain, n - no * grain)
                yield pa.RecordBatch.from_arrays([pa.array([queue] * len(no), pa.string()), pa.array(no), pa.array(rounds(quantum, last, no, grain)), pa.array(size)], names=["queue", "g", "round", "size"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = listed.mapInArrow(grains, "queue string, g long, round long, size long").repartitionByRange(parts, "round", "queue", "g").sortWithinPartitions("round", "queue", "g").select(F.spark_partition_id().alias("part"), "queue", "g", "size")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            size = np.asarray(batch.column(3))
            ends = at + np.cumsum(size)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ends - size), batch.column(3)], names=["part", "queue", "g", "within", "size"])
            at = int(ends[-1]) if len(ends) else at

    order = stored(rows.mapInArrow(summed, "part int, queue string, g long, within long, size long"), "grains")
    before, offsets = 0, []
    for part, n in sorted(map(tuple, order.groupBy("part").agg(F.sum("size")).collect())):  # a row for each partition
        offsets.append((part, before))
        before += n
    bases = spark.createDataFrame(offsets, "part int, before long")
    order = order.join(F.broadcast(bases), "part").select(F.col("queue").alias("q"), F.col("g").alias("no"), (F.col("before") + F.col("within")).alias("place"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_ in batches:
            for batch in slices(whole_, "ids", 1 << 20):
                first, n = (np.asarray(batch.column(i)).astype(np.int64) for i in (2, 3))
                g0, g1 = first // grain, (first + n - 1) // grain
                many = g1 - g0 + 1
                doc = np.repeat(np.arange(len(n)), many)
                no = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + g0[doc]
                begin, end = np.maximum(no * grain, first[doc]), np.minimum((no + 1) * grain, (first + n)[doc])
                raw = batch.column(4).to_pylist()
                ids = [raw[d][2 * a : 2 * b] for d, a, b in zip(doc.tolist(), (begin - first[doc]).tolist(), (end - first[doc]).tolist(), strict=True)]
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(no), pa.array(begin - no * grain), pa.array(begin - first[doc]), batch.column(3).take(take), pa.array(ids, pa.binary())], names=["doc_id", "queue", "g", "inside", "start", "doc_tokens", "ids"])

    held = placed.mapInArrow(cut, "doc_id long, queue string, g long, inside long, start long, doc_tokens long, ids binary")
    met = held.join(order, (F.col("queue") == F.col("q")) & (F.col("g") == F.col("no"))).select("doc_id", "queue", "start", "doc_tokens", (F.col("place") + F.col("inside")).alias("at"), "ids")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, total, at = (np.asarray(batch.column(i)).astype(np.int64) for i in (2, 3, 4))
            row, skip, out = np.arange(len(at)), np.zeros(len(at), np.int64), []
            size = np.asarray(pa.compute.binary_length(batch.column(5))).astype(np.int64) // 2
            while len(row):  # cut at the ends of sequences
                seq, off, stop = sequence(all_, window, at[row] + skip)
                n = np.minimum(size[row] - skip, stop - at[row] - skip)
                out.append((row, skip, n, seq, off))
                more = skip + n < size[row]
                row, skip = row[more], (skip + n)[more]
            row, skip, n, seq, off = (np.concatenate(x) for x in zip(*out, strict=True))
            raw = batch.column(5).to_pylist()
            sums = [zlib.crc32(np.frombuffer(raw[r], "<u2")[a : a + k].astype("<u4").tobytes()) for r, a, k in zip(row.tolist(), skip.tolist(), n.tolist(), strict=True)]
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), pa.array(start[row] + skip), pa.array(n), pa.array(sums, pa.int64()), pa.array(total[row]), pa.array(seq), pa.array(off), batch.column(1).take(take)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue"])

    return met.mapInArrow(pieces, PIECES)
