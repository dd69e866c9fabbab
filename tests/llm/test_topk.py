"""Approximation files: bounds, ties, repeats, clashing columns, ranges, and how many rows reach the final ranking."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlake.llm import topk
from claimlake.llm.shared import integer_vectors

SCHEMA = "vec_id long, embedding array<double>, score string, rank string, query_id string, v int, part int"


def made(spark, rows):
    return spark.createDataFrame([(i, e, "s", "r", "q", 1, 2) for i, e in rows], SCHEMA).repartition(4)


def brute(rows, every, k):
    good = [(i, np.floor(1024 * np.array(e)).astype(np.int64)) for i, e in rows if i is not None and e and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for q, v in {i: v for i, v in good if i % every == 0}.items():
        best = sorted((-int(v @ w), i) for i, w in good if i != q and len(w) == len(v))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("rows_a_block", [7, 4096])
def test_ties_and_dimensions(spark, monkeypatch, rows_a_block):
    monkeypatch.setattr(topk, "ROWS", rows_a_block)
    rng = np.random.default_rng(6)
    few = [[float(x) for x in rng.integers(-2, 3, 5) / 4] for _ in range(9)]
    rows = [(int(i), few[int(rng.integers(0, 9))]) for i in rng.permutation(300)]
    rows += [(1000 + i, [float(x) for x in rng.normal(0, 1, 3)]) for i in range(40)]
    rows += [(2000, [1.0]), (None, few[0]), (2100, None), (2200, []), (2300, [None] * 5), (2400, [float("inf")] * 5), rows[4], rows[4]]
    got = sorted(tuple(r) for r in topk.top_k(made(spark, rows), every=10, k=4, batch=16).collect())
    assert got == brute(rows, 10, 4)


def test_bounds_hold():
    rng = np.random.default_rng(7)
    for wide in (3, 900, 1 << 25):
        whole, queries = rng.integers(-wide, wide + 1, (200, 7)), rng.integers(-wide, wide + 1, (9, 7))
        file = topk.ApproximationFile.of(np.arange(200), whole)
        assert file.packed.nbytes == 200 * 4  # half a byte a component
        again = topk.ApproximationFile.read(*(c[0].as_py() for c in file.row().columns))
        least, most = again.bounds(queries)
        exact = queries @ whole.T
        assert (least <= exact).all() and (exact <= most).all() and (again.exact == whole).all()


def test_few_exact_vectors_are_read():
    rng = np.random.default_rng(8)
    whole = np.floor(1024 * rng.normal(0, 0.125, (4096, 64))).astype(np.int64)
    best = topk.Best(np.array([-1]), whole[:1], np.array([np.iinfo(np.int64).min]), 10)
    assert best.search(topk.ApproximationFile.of(np.arange(4096), whole)) < 1000


def test_floors_keep_the_final_ranking_small(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 50)
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 8)]) for i in range(4000)]
    whole = integer_vectors(made(spark, rows).select("vec_id", "embedding"))
    blocks = topk.files(whole.select("vec_id", "v"))
    queries = topk._query_rows(whole.filter("vec_id % 100 = 0").select("vec_id", "v"))
    first = F.pmod(F.xxhash64("ids", F.lit(1)), F.lit(topk.SAMPLE)) == 0
    free = queries.withColumn("floor", F.lit(topk._NONE).cast("long"))
    sample = topk.searched(blocks.filter(first), free, 40, 1, 5).collect()
    kth = {}
    for r in sample:
        kth.setdefault(r.query_id, []).append(r.score)
    floors = spark.createDataFrame([(q, sorted(s)[-5]) for q, s in kth.items()], "query_id long, floor long")
    after = topk.searched(blocks.filter(~first), queries.join(floors, "query_id"), 40, 1, 5).count()
    assert after <= 3 * topk.SAMPLE * 5 * 40 and after < topk.searched(blocks.filter(~first), free, 40, 1, 5).count()


def test_range_and_empty(spark):
    with pytest.raises(Exception, match="out of range"):
        topk.top_k(made(spark, [(0, [1e300]), (1, [1.0])])).collect()
    assert topk.top_k(made(spark, []).limit(0)).collect() == []
    assert topk.top_k(made(spark, [(1, [1.0]), (2, [1.0])])).collect() == []
    assert topk.top_k(made(spark, [(0, [1.0])])).collect() == []
