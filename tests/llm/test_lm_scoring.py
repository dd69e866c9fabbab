"""The n-gram trie against plain Python, its sequences, shards and classes, held-out gain, edges."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from claimlake.llm import lm_scoring
from claimlake.llm.elias_fano import EliasFano, Trie, discounts, quantised, restored
from claimlake.llm.shared import span_hashes


@pytest.mark.parametrize("case", ["dense", "sparse", "equal", "one", "none", "wide"])
def test_elias_fano(case):
    rng = np.random.default_rng(1)
    values = {"dense": np.arange(0, 900, 1), "sparse": np.sort(rng.integers(0, 10**9, 5000)), "equal": np.sort(rng.integers(0, 40, 3000)), "one": np.array([77]), "none": np.zeros(0, np.int64), "wide": np.sort(rng.integers(0, 2**50, 400))}[case].astype(np.int64)
    top = int(values.max(initial=0)) + 1
    ef = EliasFano.of(values, top)
    assert (ef.all() == values).all() and (ef.get(np.arange(len(values))) == values).all()
    asked = np.concatenate([values, values + 1, np.maximum(values - 1, 0), rng.integers(0, 2 * top, 500), [0]])
    place, found = ef.place(asked)
    assert (place == np.searchsorted(values, asked)).all() and (found == np.isin(asked, values)).all()
    if case == "sparse":
        assert sum(a.nbytes for a in ef.arrays()) * 8 / len(values) < 2 + math.log2(top / len(values)) + 3


def grams(rng, n, ids):
    rows = np.unique(np.stack([rng.integers(0, 6, n), rng.integers(0, ids, n), rng.integers(1, ids, n)], axis=1), axis=0)
    return (*rows.T, rng.integers(1, 6, len(rows)))


def test_trie_sums_to_one_and_survives_mapping(tmp_path):
    root, before, word, count = grams(np.random.default_rng(2), 700, 25)
    trie = Trie.build(root, before, word, count)
    trie.write(str(tmp_path / "t"))
    mapped = Trie.opened(str(tmp_path / "t"))
    assert isinstance(mapped.levels["grams"].high.base, np.ndarray | np.memmap)
    for r in range(8):
        for u in (0, 3, 24, 99):
            w = np.arange(200)
            own, left = mapped.ask(np.full(200, r), np.full(200, u), w)
            again = trie.ask(np.full(200, r), np.full(200, u), w)
            assert (own == again[0]).all() and (left == again[1]).all()
            single = np.full(200, 1 / 200)
            assert abs((restored(own) + restored(left) * single).sum() - 1) < 0.01


def brute(rows, most, sharded):
    """score() in plain Python. sharded: the shard of a root."""
    texts = [(i, ["" if t is None else re.sub("[A-Z]", lambda m: m[0].lower(), t)][0]) for i, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in texts]
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", t) + [None] for _, t in texts]
    c = Counter(w for ws, h in zip(tokens, held, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)

    def code(w):
        if w in ("START", None):
            return {"START": 0, None: None}[w]
        return w

    def contexts(ws):
        for j, w in enumerate(ws):
            yield (ws[j - 1] if j else "START"), (ws[j - 2] if j > 1 else "START"), w

    shards = defaultdict(Counter)
    for ws, h in zip(tokens, held, strict=True):
        if not h:
            for v_, u, w in contexts(ws):
                root = (v_, sharded["class"](u, c[v_] if v_ != "START" else 0))
                shards[sharded["shard"](root)][root, u, w] += 1
    out = []
    for (i, _), h, ws in zip(texts, held, tokens, strict=True):
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        total = 0.0
        for v_, u, w in contexts(ws):
            p1 = (c[w] + 0.5) / (n + 0.5 * (v + 1))
            root = (v_, sharded["class"](u if u == "START" or u in c else "UNSEEN", c[v_] if v_ != "START" else 0))
            own = shards[sharded["shard"](root)]
            pairs = Counter((r, x) for r, _, x in own)
            d2 = discounts(np.array(list(pairs.values()))) if pairs else None
            d3 = discounts(np.array(list(own.values()))) if own else None
            follow = {x: k for (r, x), k in pairs.items() if r == root}
            p = p1
            if follow and (v_ == "START" or v_ in c):
                t = sum(follow.values())
                p = (follow.get(w, 0) - d2[min(follow.get(w, 0), 3)] + sum(d2[min(k, 3)] for k in follow.values()) * p) / t
                exact = {x: k for (r, y, x), k in own.items() if r == root and y == u}
                if exact:
                    t = sum(exact.values())
                    p = (exact.get(w, 0) - d3[min(exact.get(w, 0), 3)] + sum(d3[min(k, 3)] for k in exact.values()) * p) / t
            total += math.log10(p)
        out.append((i, h, len(ws), sum(c[w] > 0 for w in ws), n, base, total))
    return out


SCHEMA = "doc_id long, text string, n int, shard int, block string, score string"


def some_rows():
    rng = np.random.default_rng(4)
    vocab = [f"w{i}" for i in range(12)] + ["The", "the", "É", "END"]
    rows = [(int(i), " ".join(rng.choice(vocab, int(rng.integers(0, 25)), p=[0.4, *[0.04] * 15])) + (" only%d" % i if i % 9 == 0 else "")) for i in range(60)]
    return [*rows, rows[3], (70, None), (71, ""), (72, " \n\t "), (None, "w1 w2 w3"), (None, None), (73, "w0 " * 400)]


def same(got, want):
    key = lambda r: (str(r[0]), r[2], r[6])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert abs(g[5] - w[5]) < 1e-9 * max(1, abs(w[5])) and abs(g[6] - w[6]) < 0.006 * w[2], (g, w)


@pytest.mark.parametrize("block", [10**6, 60])
def test_score_of_one_shard(spark, block):
    rows = some_rows()
    df = spark.createDataFrame([(*r, 1, 2, "b", "s") for r in rows], SCHEMA).repartition(3)
    same(lm_scoring.score(df, block=block).collect(), brute(rows, 10**6, {"class": lambda u, c: 0, "shard": lambda r: 0}))


def test_vocabulary_shards_agree(spark):
    rows = some_rows()
    df = spark.createDataFrame([(*r, 1, 2, "b", "s") for r in rows], SCHEMA).repartition(3)
    same(lm_scoring.score(df, block=60, words=4).collect(), brute(rows, 10**6, {"class": lambda u, c: 0, "shard": lambda r: 0}))


def test_hot_contexts_are_parted(spark):
    """Classes and shards come from the ids that the vocabulary gives; a plain count by these ids must agree."""
    rows = some_rows()
    c = Counter(w for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 5 != 1 for w in [*(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))), None])

    def hashed(w):
        if w is None:
            return 0
        raw = np.frombuffer(w.encode(), np.uint8)
        return int(span_hashes(raw, np.array([0]), np.array([len(raw)]))[0])

    order = sorted(c, key=lambda w: (-c[w], hashed(w)))
    ids = {"START": 0, "UNSEEN": 1, **{w: k + 2 for k, w in enumerate(order)}}
    most, n = 40, sum(c.values())

    def klass(u, count):
        return int(lm_scoring.classes(np.array([ids[u]]), np.array([count]), most)[0])

    def shard(root):
        return int(lm_scoring.mixed(np.array([ids[root[0]] << 20 | root[1]], np.uint64))[0] % np.uint64(-(-n // most))) if root[0] in ids else -1

    df = spark.createDataFrame([(*r, 1, 2, "b", "s") for r in rows], SCHEMA).repartition(2)
    same(lm_scoring.score(df, block=200, most=most).collect(), brute(rows, most, {"class": klass, "shard": shard}))


def test_edges_and_gain(spark, sf_dir):
    assert lm_scoring.score(spark.createDataFrame([], SCHEMA)).collect() == []
    held_only = [(i, "a b a") for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]
    got = lm_scoring.score(spark.createDataFrame([(*r, 1, 2, "b", "s") for r in held_only], SCHEMA)).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got} == {(4, 0, 0, 0.0, 0.0)}
    long = " ".join(f"w{i % 5000}" for i in range(300_000))
    got = lm_scoring.score(spark.createDataFrame([(i, long, 1, 2, "b", "s") for i in (2, 3, 4)], SCHEMA)).collect()
    assert all(r.n_tokens == 300_001 and r.score > r.base_score for r in got)
    real = [r for r in lm_scoring.score(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect() if r.held_out]
    assert sum(r.score for r in real) > sum(r.base_score for r in real)


def test_quantised():
    p = np.array([0.0, 1.0, 0.3, 1e-12, 1e-200])
    assert restored(quantised(p))[0] == 0 and np.allclose(np.log10(restored(quantised(p))[1:]), np.log10(p[1:]), atol=0.5 / 256)
