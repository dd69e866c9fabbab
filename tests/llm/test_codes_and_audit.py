"""Vector codes and the divergence audit against brute force, with nulls, ties, repeats, clashing columns and empty tables."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from claimlake.llm import divergence, vector_codes

VECTORS = "vec_id long, embedding array<double>, label int, code int, error string, v int"


def brute_codes(rows, parts, entries, rounds):
    rows = [(i, [int(np.floor(1024 * x)) for x in e], lab) for i, e, lab in rows if e and all(x is not None and np.isfinite(x) for x in e)]
    rows.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    w = len(rows[0][1]) // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for _, v, _ in rows]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, g in zip(cut, got, strict=True) if g[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    got, by = assign(), defaultdict(int)
    for (_, _, lab), g in zip(rows, got, strict=True):
        by[lab] += sum(d for d, _ in g)
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((str(i), "".join(f"{k:02x}" for _, k in g), sum(d for d, _ in g), by[lab], sha) for (i, _, lab), g in zip(rows, got, strict=True))


@pytest.mark.parametrize("entries", [3, 40])
def test_codes(spark, entries):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.01 if i % 3 else 2, 8)], None if i % 4 == 0 else int(i % 5)) for i in rng.permutation(150)]
    rows += [rows[0], (7, rows[1][1], 1), (None, rows[2][1], None), (900, None, 1), (901, [], 1), (902, [float("nan")] * 8, 1), (903, [float("inf")] * 8, 1), (904, [None] * 8, 1), (905, [0.5] * 8, 1), (906, [0.5] * 8, 1)]
    df = spark.createDataFrame([(*r, 1, "e", 2) for r in rows], VECTORS).repartition(3)
    got = sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.compress(df, entries=entries).collect())
    assert got == brute_codes(rows, 4, entries, 4)


def test_codes_edges(spark):
    none = spark.createDataFrame([], VECTORS)
    assert vector_codes.compress(none).collect() == []
    assert vector_codes.compress(spark.createDataFrame([(1, None, 1, 1, "e", 1)], VECTORS)).collect() == []
    for bad in ([(1, [1.0] * 8), (2, [1.0] * 4)], [(1, [1.0] * 6)], [(1, [1e300] * 8)]):
        with pytest.raises(Exception, match="length|components|range"):
            vector_codes.compress(spark.createDataFrame([(i, e, 1, 1, "e", 1) for i, e in bad], VECTORS)).collect()


def test_dictionaries_give_exact_distances():
    rng = np.random.default_rng(3)
    for wide in (50, 1 << 24):
        v, books = rng.integers(-wide, wide, (1500, 12)), rng.integers(-wide, wide, (3, 37, 4))
        block = vector_codes.Block.of(v)
        best, least = vector_codes.Block.read(len(v), *block.parts()).nearest(books)
        exact = ((v.reshape(-1, 3, 1, 4) - books[None]) ** 2).sum(axis=3)
        assert (best == exact.argmin(axis=2).T).all() and (least == exact.min(axis=2).T).all()


DOCS = "doc_id long, text string, lang string, source string, term string, n int, p int, value string"


def brute_audit(rows, least, scale, weight, most):
    rows = [tuple(x or "" for x in r[1:4]) for r in rows]
    words = [Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))) for t, _, _ in rows]
    out = []
    for lang in {r[1] for r in rows}:
        df, by, all_ = Counter(), defaultdict(Counter), Counter()
        for (_, own, source), c in zip(rows, words, strict=True):
            if own == lang:
                df.update(c.keys())
                by[source].update(c)
        kept = sorted(t for t in df if df[t] >= least)
        for c in by.values():
            all_.update(c)

        def share(c, t):
            return 1 + scale * (c[t] + weight) // (sum(c[x] for x in kept) + weight * len(kept))

        for s in by:
            pairs = [(o, sum(abs(share(by[s], t) - share(by[o], t)) for t in kept)) for o in by if o != s]
            terms = [(t, share(by[s], t) - share(all_, t)) for t in kept if by[s][t] and share(by[s], t) > share(all_, t)]
            for part, items, cut in (("pair", pairs, None), ("term", terms, most)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, v, i + 1) for i, (t, v) in enumerate(items[:cut])]
    return sorted(out)


@pytest.mark.parametrize("sides", [(256, 4096), (2, 3)])
def test_audit(spark, monkeypatch, sides):
    monkeypatch.setattr(divergence, "GROUPS", sides[0])
    monkeypatch.setattr(divergence, "TERMS", sides[1])
    rng = np.random.default_rng(8)
    vocab = ["Word", "été", "a", "I'm", "東京", "x9y", "Ünder", "same", "rare", "ÀB", "zz", "ZZ"]
    rows = [(int(i), " ".join(rng.choice(vocab, int(rng.integers(0, 30)))), ["en", "de", None][i % 3], [None, "s1", "s2", "s3", "S4", "é"][int(rng.integers(0, 6)) if i > 3 else 1]) for i in range(160)]
    rows += [rows[0], (None, None, "en", "empty"), (500, "", "fr", "alone"), (501, "only once", "it", "a"), (502, "", "it", "b"), (503, "hot " * 3000 + "\x00\x7f", "en", "s1")]
    df = spark.createDataFrame([(*r, "t", 1, 2, "v") for r in rows], DOCS).repartition(3)
    got = sorted(tuple(r) for r in divergence.audit(df, least_docs=4, most=3).collect())
    assert got == brute_audit(rows, 4, 10**9, 5, 3)


def test_audit_edges(spark, monkeypatch):
    assert divergence.audit(spark.createDataFrame([], DOCS)).collect() == []
    monkeypatch.setattr(divergence, "PIECE", 64)
    text = "Été déjà vu; " * 40 + "x" * 300 + " end " + "y" * 200
    assert [w for p in divergence._pieces(text.encode()) for w in p] == [w.encode() for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))]
