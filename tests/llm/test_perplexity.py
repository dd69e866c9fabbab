import math
import zlib
from collections import Counter, defaultdict

import numpy as np

from claimlake.llm import perplexity

ORDER = 5


def seen(text):
    return b"\2" * (ORDER - 1) + bytes(48 if 48 <= b < 58 else b for b in (text or "").encode())


def grams(text):
    s = seen(text)
    return [s[i : i + ORDER] for i in range(len(s) - ORDER + 1)]


def discounts(counts):
    n = Counter(counts)
    if not (n[1] and n[2] and n[3]):
        return (0.0, 0.5, 1.0, 1.5)
    y = n[1] / (n[1] + 2 * n[2])
    return (0.0, *(min(k - 0.05, max(0.05, k - (k + 1) * y * n[k + 1] / n[k])) for k in (1, 2, 3)))


class Brute:
    def __init__(self, texts):
        self.counts = {ORDER: Counter(g for t in texts for g in grams(t))}
        for k in range(ORDER - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.d = {k: discounts(c.values()) for k, c in self.counts.items()}
        self.follow = {k: defaultdict(list) for k in self.counts}
        for k, c in self.counts.items():
            for g, n in c.items():
                self.follow[k][g[:-1]].append(n)

    def p(self, g):
        if not g:
            return 1 / 256
        low, own, d = self.p(g[1:]), self.follow[len(g)].get(g[:-1]), self.d[len(g)]
        if not own:
            return low
        n = self.counts[len(g)][g]
        return (n - d[min(n, 3)] + sum(d[min(k, 3)] for k in own) * low) / sum(own)

    def perplexity(self, text):
        g = grams(text)
        return math.exp(-sum(math.log(self.p(x)) for x in g) / len(g))


def held(i):
    return zlib.crc32(str(i).encode()) % perplexity.FOLDS == 0


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1.0, "x", True) for i, t, lang in rows], "doc_id long, text string, lang string, n double, key string, held boolean")


def test_matches_brute_force(spark):
    base = "the cat sat on the mat and 12 dogs saw that the cat had sat where the rat sat at 3".split()
    texts = [" ".join(base[i % 9 :] + base[: i // 2]) for i in range(40)] + ["", None, "zz é 東京 qq", "  ", "a", "the cat " * 30_000]
    rows = [(i, t, ("en", "de", None)[i % 3]) for i, t in enumerate(texts)] + [(3, texts[3], "en"), (None, "null id", "en")]
    docs = frame(spark, rows).repartition(3)
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(40)] + [(None, 1), (2, None), (3, 1)], "doc_id long, quality int")
    trusted = [(i, t) for i, t, _ in rows if i is not None and i < 30]
    model = Brute([t for i, t in trusted if not held(i)])
    got = perplexity.score(docs, labels, quantile=0.9, most_bytes=1000).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, *_ in rows)
    text, lang = {i: t for i, t, _ in rows}, {i: x for i, _, x in rows}
    own = defaultdict(list)
    for i, t in trusted:
        if held(i):
            own[lang[i]].append(model.perplexity(t))
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert r.n_bytes == len(raw)
        if not raw:
            assert r.perplexity is None and not r.kept
            continue
        want = model.perplexity(text[r.doc_id])
        assert abs(r.perplexity - want) < 1e-9 * want
        x = own[lang[r.doc_id]] or [p for v in own.values() for p in v]
        at = sorted(x)[max(0, math.ceil(0.9 * len(x)) - 1)]
        assert abs(r.threshold - at) < 1e-9 * at and r.kept == (r.perplexity <= r.threshold)


def test_probabilities_add_up():
    model = Brute(["abab cab abba cab", "abc abd"])
    for context in (b"abab", b"zzzz", b"\2\2\2\2", b" cab"):
        assert abs(sum(model.p(context + bytes([b])) for b in range(256)) - 1) < 1e-9


def test_nothing_trusted_and_no_rows(spark):
    docs = frame(spark, [(1, "ab", "en"), (2, "", "en")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = {r.doc_id: r for r in perplexity.score(docs, none).collect()}
    assert abs(got[1].perplexity - 256) < 1e-9 and got[1].threshold is None and got[1].kept and not got[2].kept
    assert perplexity.score(docs.limit(0), none).count() == 0


def test_separates_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = [r for r in perplexity.score(spark.read.parquet(f"{d}/documents.parquet"), labels).join(labels, "doc_id").collect() if held(r.doc_id) and r.perplexity]
    order = np.argsort(np.argsort([r.perplexity for r in rows]))
    bad = np.array([r.quality == 0 for r in rows])
    area = (order[bad].sum() - bad.sum() * (bad.sum() - 1) / 2) / bad.sum() / (~bad).sum()
    kept = np.array([r.kept for r in rows])
    print(area, kept[bad].mean(), kept[~bad].mean())
    assert area > 0.97 and kept[bad].mean() < 0.2 and kept[~bad].mean() > 0.97
