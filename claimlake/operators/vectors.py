"""Vectors near each other: all pairs over a cosine threshold, without comparing what an angle rules out."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pivots that cells are formed around, rows of a cell's piece, and rows that are compared at once.
PIVOTS, PIECE, CHUNK = 64, 8192, 256
#: What rounding may shift an angle or a cosine by.
SLACK = 1e-9


def _unit(v: np.ndarray) -> np.ndarray:
    length = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return np.where(length > 0, v / np.where(length > 0, length, 1), 0.0)


def near_pairs(vectors: DataFrame, key: str, vector: str, least: float, pivots: int = PIVOTS) -> DataFrame:
    """a, b, cosine: every pair of rows a < b whose vectors have a cosine of least or more (over 0).

    Null and zero vectors, those with null or non-finite components, and null keys take no part; a key is expected
    once. Every vector lives in the cell of its nearest pivot (pivots: the vectors with the smallest hashes of their
    keys, so many at most) and visits each cell whose residents may be near enough: on a sphere, two vectors can be
    within an angle only if their angles to a pivot differ by no more than that, so a cell is passed over if even its
    farthest resident stands too near its pivot. A visitor comes to a cell only from one with a smaller number, so a pair
    meets once. Cells of many residents are parted by hash; a piece gets all the cell's visitors and no pair leaves a
    task unless it is a hit. A worker holds the residents of one piece and CHUNK of its visitors, who stream by. Vectors of another length than the pivots' are an error.
    """
    if not 0 < least <= 1:
        raise ValueError("least must be over 0 and at most 1")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter("id IS NOT NULL AND size(v) > 0")
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    chosen = [r.v for r in rows.orderBy(F.xxhash64("id"), "id").limit(pivots).select("v").collect()]  # pivots rows at most
    if not chosen:
        return vectors.sparkSession.createDataFrame([], "a long, b long, cosine double")
    centre = _unit(np.array(chosen))
    reach = float(np.arccos(least)) + SLACK

    def angles(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        v = _unit(np.asarray(batch.column(1).flatten()).reshape(batch.num_rows, -1))
        return v, np.arccos(np.clip(v @ centre.T, -1, 1))

    def settle(batches):
        for batch in batches:
            if batch.num_rows:
                at = angles(batch)[1]
                home = at.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(home), pa.array(at[np.arange(len(home)), home]), pa.array(np.ones(len(home), np.int64))], names=["cell", "far", "n"])

    sizes = rows.mapInArrow(settle, "cell long, far double, n long").groupBy("cell").agg(F.max("far").alias("far"), F.sum("n").alias("n")).collect()  # a row for each pivot
    far, pieces = np.full(len(centre), -np.inf), np.ones(len(centre), np.int64)
    for r in sizes:
        far[r.cell], pieces[r.cell] = r.far, -(-r.n // PIECE)

    def send(batches):
        for big in batches:
            for at_row in range(0, big.num_rows, CHUNK):
                batch = big.slice(at_row, CHUNK)
                v, at = angles(batch)
                ids = np.asarray(batch.column(0))
                home = at.argmin(axis=1)
                # mixed, as ids may all be multiples of some number
                own = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % pieces[home]
                raw = pa.array([x.tobytes() for x in v], pa.binary())
                for c in range(len(centre)):
                    lives = home == c
                    i = np.flatnonzero(lives | ((at[:, c] - reach <= far[c]) & (home < c)))
                    first = np.where(lives[i], own[i], 0)
                    for p in range(int(pieces[c])):
                        r = i[first <= p]
                        if len(r):
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), c)), pa.array(np.full(len(r), p)), pa.array(ids[r]), pa.array(lives[r] & (own[r] == p)), raw.take(pa.array(r))], names=["cell", "piece", "id", "lives", "v"])

    def meet(batches):
        place, held = None, []  # residents of the piece at hand, who come before its visitors
        for big in batches:
            for at in range(0, big.num_rows, CHUNK):
                batch = big.slice(at, CHUNK)
                where = np.stack([np.asarray(batch.column(0)), np.asarray(batch.column(1))])
                cuts = [0, *(np.flatnonzero((where[:, 1:] != where[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
                for low, high in zip(cuts, cuts[1:], strict=False):
                    part = batch.slice(low, high - low)
                    if place != (here := tuple(where[:, low].tolist())):
                        place, held = here, []
                    ids, lives = np.asarray(part.column(2)), np.asarray(part.column(3)).astype(bool)
                    v = np.frombuffer(b"".join(part.column(4).to_pylist()), np.float64).reshape(len(ids), -1)
                    if lives.any():
                        held.append((ids[lives], v[lives]))
                    for k, (own, hv) in enumerate(held):
                        cos = v @ hv.T
                        i, j = np.nonzero(cos >= least - SLACK)
                        x, y = ids[i], own[j]
                        # of residents of one chunk each pair comes twice, and once from different chunks
                        keep = (x != y) & (~lives[i] | (x < y) | (k < len(held) - 1))
                        if keep.any():
                            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)[keep]), pa.array(np.maximum(x, y)[keep]), pa.array(cos[i, j][keep])], names=["a", "b", "cosine"])

    met = rows.mapInArrow(send, "cell long, piece long, id long, lives boolean, v binary")
    dealt = met.repartition("cell", "piece").sortWithinPartitions("cell", "piece", F.col("lives").desc())
    return dealt.mapInArrow(meet, "a long, b long, cosine double").filter(F.col("cosine") >= least)


def best_in_catalog(vectors: DataFrame, catalog: DataFrame, key: str, name: str, vector: str, least: float) -> DataFrame:
    """key, name, cosine: the entry of a catalog (name, vector) nearest to each row, null under least; ties to the smaller name. The catalog is a vocabulary of some hundreds, checked to be at most 10,000."""
    entries = catalog.filter(f"size(`{vector}`) > 0").select(name, vector).orderBy(name).limit(10_001).collect()
    if len(entries) > 10_000:
        raise ValueError("a catalog has at most 10,000 entries")
    labels = [r[0] for r in entries]
    matrix = _unit(np.array([r[1] for r in entries], np.float64)) if entries else np.zeros((0, 0))

    def run(batches):
        for batch in batches:
            v = batch.column(1)
            out, cos = [], []
            for i in range(batch.num_rows):
                x = v[i].as_py()
                if x and len(labels) and len(x) == matrix.shape[1] and all(e is not None and np.isfinite(e) for e in x):
                    sims = matrix @ _unit(np.array([x], np.float64))[0]
                    at = int(sims.argmax())
                    if sims[at] >= least:
                        out.append(labels[at])
                        cos.append(float(sims[at]))
                        continue
                out.append(None)
                cos.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), pa.array(cos, pa.float64())], names=["key", "name", "cosine"])

    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "key long, name string, cosine double").withColumnsRenamed({"key": key, "name": name})


def two_signal_links(people: DataFrame, pairs: DataFrame, node: str, name_key: str, allowed=None) -> DataFrame:
    """Links (a, b, signal) of persons: those of one non-empty name key are chained to their first, and pairs (a, b) of near vectors are added where names have not linked them and allowed (a Column over a_, b_ columns) does not forbid it.

    people: one row for each node. Nodes of one name key count as linked.
    """
    from .clusters import chained

    named = people.filter(F.col(name_key) != "")
    chain = chained(named, [name_key], node, node).select("a", "b", F.lit("name").alias("signal"))
    columns = [c for c in people.columns if c != node]
    a = people.select(F.col(node).alias("a"), *(F.col(c).alias(f"a_{c}") for c in columns))
    b = people.select(F.col(node).alias("b"), *(F.col(c).alias(f"b_{c}") for c in columns))
    met = pairs.select("a", "b").join(a, "a").join(b, "b")
    apart = ~F.coalesce((F.col(f"a_{name_key}") == F.col(f"b_{name_key}")) & (F.col(f"a_{name_key}") != ""), F.lit(False))
    if allowed is not None:
        apart = apart & F.coalesce(allowed, F.lit(True))
    return chain.unionByName(met.filter(apart).select("a", "b", F.lit("vector").alias("signal")))
