"""Interpolated modified Kneser-Ney model of trusted text over byte n-grams; perplexity by sharded count joins, thresholds by language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import buffers, forget, slices, stored

#: Bytes in an n-gram (a key holds 7 at most), and the byte that stands before a text's first one.
ORDER, PAD = 5, 2
#: Rows of trusted ids up to which they are broadcast; joined by hash beyond.
BROADCAST_ROWS = 5_000_000
#: Discounts of counts 1, 2 and 3 or more where the counts of counts leave them undefined.
FALLBACK = (0.5, 1.0, 1.5)
#: Every fifth trusted text is held out of training, and its perplexity counts for the thresholds.
FOLDS = 5

_SHIFT = np.uint64(8)
_SEEN = np.arange(256, dtype=np.uint64)
_SEEN[48:58] = 48  # digits count as 0


def ngrams(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the texts, the code of the n-gram that it ends, and offsets; PAD stands before a text's first byte."""
    data, offsets = buffers(texts)
    n, size = len(offsets) - 1, np.diff(offsets)
    at = np.arange(len(data)) + (order - 1) * (np.repeat(np.arange(n), size) + 1)
    padded = np.full(len(data) + (order - 1) * n, PAD, np.uint64)
    padded[at] = _SEEN[data]
    code = np.zeros(len(data), np.uint64)
    for i in range(order - 1, -1, -1):
        code = code << _SHIFT | padded[at - i]
    return code, offsets


def _keys(length: int, codes: np.ndarray) -> np.ndarray:
    return (codes | np.uint64(length << 56)).astype(np.int64)


def _suffix(codes: np.ndarray, length: int) -> np.ndarray:
    return codes & np.uint64((1 << 8 * length) - 1)


def counted(texts: DataFrame, order: int) -> DataFrame:
    """code, n: the n-grams of all texts (text) and how often they stand there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in slices(big, "text", 2 << 20):
                codes, n = np.unique(ngrams(batch.column(0), order)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(n)], names=["code", "n"])

    return texts.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def trained(texts: DataFrame, order: int) -> tuple[DataFrame, list[tuple[float, float, float]]]:
    """The model of the texts, and the discounts for each length from 1 to order.

    A row for each n-gram of every length from 0: key (length and code), n (its count; below the full length, how many
    bytes stand before it), and what follows it as a context: total of the counts one byte longer, and how many of
    these are 1, 2, and 3 or more.
    """
    top = stored(counted(texts, order), "ngrams")
    levels = [top.select(F.lit(order).alias("length"), "code", "n")]
    for k in range(order - 1, 0, -1):
        levels.append(levels[-1].groupBy(F.col("code").bitwiseAND((1 << 8 * k) - 1).alias("code")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("length"), "code", "n"))
    none = F.lit(0).cast("long")
    parts = []
    for rows in levels:
        parts.append(rows.select("length", "code", "n", none.alias("total"), none.alias("n1"), none.alias("n2"), none.alias("n3")))
        many = rows.groupBy((F.col("length") - 1).alias("length"), F.shiftright("code", 8).alias("code"))
        follow = many.agg(F.sum("n").alias("total"), F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"), F.count_if(F.col("n") > 2).alias("n3"))
        parts.append(follow.select("length", "code", none.alias("n"), "total", "n1", "n2", "n3"))
    every = parts[0]
    for x in parts[1:]:
        every = every.union(x)
    key = F.shiftleft(F.col("length").cast("long"), 56).bitwiseOR(F.col("code"))
    model = stored(every.groupBy(key.alias("key")).agg(*(F.sum(c).alias(c) for c in ("n", "total", "n1", "n2", "n3"))), "model")
    forget(top)
    seen = model.filter("n > 0").groupBy(F.shiftright("key", 56).alias("length")).agg(*(F.count_if(F.col("n") == k).alias(f"c{k}") for k in (1, 2, 3, 4)))
    discounts = {r.length: _discounts(r.c1, r.c2, r.c3, r.c4) for r in seen.collect()}  # a row for each length
    return model, [discounts.get(k, FALLBACK) for k in range(1, order + 1)]


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts of counts of one, two, and three or more, from how many counts are 1 to 4; FALLBACK where one of the first three is missing."""
    if not (n1 and n2 and n3):
        return FALLBACK
    y = n1 / (n1 + 2 * n2)
    return tuple(min(k - 0.05, max(0.05, k - (k + 1) * y * b / a)) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))


def blocks(docs: DataFrame, most_bytes: int) -> DataFrame:
    """block, raw: rows (doc_id, lang, held, text) that follow each other, about most_bytes of text each, as one compressed Arrow stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, held, size = None, 0, [], 0

        def row():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for x in held:
                    out.write_batch(x)
            return pa.RecordBatch.from_arrays([pa.array([part << 32 | nth], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "raw"])

        for big in batches:
            for batch in slices(big, "text", 1 << 20):
                part = batch.column(0)[0].as_py()
                own = pa.compute.sum(pa.compute.binary_length(batch.column(4))).as_py() or 0
                if held and size + own > most_bytes:
                    yield row()
                    nth, held, size = nth + 1, [], 0
                held.append(pa.RecordBatch.from_arrays(batch.columns[1:], names=["doc_id", "lang", "held", "text"]))
                size += own
        if held:
            yield row()

    rows = docs.select(F.spark_partition_id().alias("part"), "doc_id", "lang", "held", "text")
    return rows.mapInArrow(run, "block long, raw binary")


def _opened(raw: bytes) -> Iterator[pa.RecordBatch]:
    yield from pa.ipc.open_stream(pa.py_buffer(raw))


def asked(packed: DataFrame, order: int) -> DataFrame:
    """block, key: each n-gram of a block's texts, of any length, once for the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch.column(0), batch.column(1), strict=True):
                codes = np.zeros(0, np.uint64)
                for part in _opened(raw.as_buffer()):
                    codes = np.union1d(codes, ngrams(part.column(3), order)[0])
                keys = []
                for k in range(order, 0, -1):  # a gram, what it continues, and what is left of it without its first byte
                    keys.append(_keys(k, codes))
                    codes = np.union1d(_suffix(codes, k - 1), codes >> _SHIFT)
                keys = np.concatenate([*keys, _keys(0, codes)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), block.as_py())), pa.array(keys)], names=["block", "key"])

    return packed.mapInArrow(run, "block long, key long")


class Model:
    """What a block asked of the model: natural logarithms of the probabilities of its n-grams."""

    def __init__(self, answers: pa.Table, discounts: list[tuple[float, float, float]], order: int):
        self.order, self.discounts = order, discounts
        key = np.asarray(answers["key"])
        by = np.argsort(key)
        self.key = key[by]
        self.n, self.total, *self.follow = (np.asarray(answers[c]).astype(np.float64)[by] for c in ("n", "total", "n1", "n2", "n3"))

    def _rows(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.key):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)
        return at, self.key[at] == keys

    def _probability(self, codes: np.ndarray, k: int) -> np.ndarray:
        """Of the last byte of k-grams after the others. codes: sorted, distinct."""
        if not k:
            return np.full(len(codes), 1 / 256)
        shorter, back = np.unique(_suffix(codes, k - 1), return_inverse=True)
        p = self._probability(shorter, k - 1)[back]
        at, known = self._rows(_keys(k - 1, codes >> _SHIFT))
        total = np.where(known, self.total[at], 0.0) if len(self.key) else np.zeros(len(codes))
        if not total.any():
            return p
        own, seen = self._rows(_keys(k, codes))
        n, d = np.where(seen, self.n[own], 0.0), np.array([0.0, *self.discounts[k - 1]])
        taken = sum(x * c[at] for x, c in zip(self.discounts[k - 1], self.follow, strict=True))
        some = np.maximum(total, 1)
        return np.where(total > 0, (n - d[np.minimum(n, 3).astype(int)] + taken * p) / some, p)

    def logs(self, codes: np.ndarray) -> np.ndarray:
        return np.log(self._probability(codes, self.order))


def scored(packed: DataFrame, answers: DataFrame, discounts: list[tuple[float, float, float]], order: int) -> DataFrame:
    """doc_id, lang, held, n_bytes, perplexity of every row of the blocks."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        model, out = Model(right, discounts, order), []
        for raw in left["raw"]:
            for part in _opened(raw.as_buffer()):
                codes, offsets = ngrams(part.column(3), order)
                some, back = np.unique(codes, return_inverse=True)
                sums = np.concatenate([[0.0], np.cumsum(model.logs(some)[back])])
                size = np.diff(offsets)
                mean = (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(size, 1)
                out.append(pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(size), pa.array(np.exp(-mean), mask=size == 0)], names=["doc_id", "lang", "held", "n_bytes", "perplexity"]))
        return pa.Table.from_batches(out)

    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, "doc_id long, lang string, held boolean, n_bytes long, perplexity double")


def score(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, order: int = ORDER, most_bytes: int = 32 << 20) -> DataFrame:
    """doc_id, n_bytes, perplexity (of a byte), threshold and kept of every whole text.

    docs: doc_id, text, lang; other columns are ignored. labels: doc_id, quality; trusted: texts with a label of
    quality 1. Of these, the ones whose crc32(doc_id as text) is divisible by FOLDS are held out, the rest train the
    model. Bytes are the model's symbols, digits count as one. Rows that follow each other form blocks of about
    most_bytes; a block asks for each of its distinct n-grams once, the questions meet the model by key, and the
    answers meet the block's texts, so no count table stands whole anywhere and a frequent n-gram costs a row for each
    block. threshold: the quantile of the perplexities of a language's held-out texts, of all held-out texts where a
    language has none, null without any; kept: not above it. Null, empty texts: n_bytes 0, perplexity null, not kept.
    Null lang: a language of its own. Null doc_id: never trusted. Repeated rows: a row each. Without trusted texts
    every byte has probability 1/256. No rows: no rows.
    """
    good = labels.filter("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("good")).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    if good.count() <= BROADCAST_ROWS:
        good = F.broadcast(good)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang")).join(good, "doc_id", "left").withColumn("held", F.col("good") & held)
    model, discounts = trained(rows.filter(F.col("good") & ~held), order)
    packed = blocks(rows, most_bytes).repartition("block")
    answers = asked(packed, order).join(model, "key").select("block", "key", "n", "total", "n1", "n2", "n3")
    out = stored(scored(packed, answers, discounts, order), "perplexities")
    forget(model)
    tried = out.filter("held AND perplexity IS NOT NULL")
    point = F.percentile_approx("perplexity", quantile, 10_000)
    limits = tried.groupBy("lang").agg(point.alias("own"))
    anyone = tried.agg(point.alias("general")).first()[0]
    limits = F.broadcast(limits) if limits.count() <= 10_000 else limits
    threshold = F.coalesce("own", F.lit(anyone).cast("double"))
    kept = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return out.join(limits.withColumnRenamed("lang", "lang_"), F.col("lang").eqNullSafe(F.col("lang_")), "left").withColumn("threshold", threshold).select("doc_id", "n_bytes", "perplexity", "threshold", kept.alias("kept"))
