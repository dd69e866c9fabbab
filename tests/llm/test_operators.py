import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimlake.llm import bpe, near_dedup, packing, pii, quality_rules, token_counts, topk, toxicity

CASES = [
    None,
    "",
    "   \n\t ",
    "word",
    "Write to a.b@c-d.example.org or x@y.z_w@v.u, host 10.0.0.255 not 300.1.1.1; 1.2.3.4.5.6.7.8",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, call +49 (30) 1234-5678 9. ÄÖ😀 +1 555 010 9999",
    "IBAN DE89 3704 0044 0532 0130 00 and DE88 3704 0044 0532 0130 00",
    "same line here\nsame line here\n\nsame line here\nother $ % # line",
    "one two three one two three four one two three",
    "a@" * 3000 + "1" * 5000 + "." * 3000,
    "ß é <|endoftext|> naïve   x\n\n\nEND'll we’re 東京 😀😀",
]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    real = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    rows = [(i, t, f"s{i % 3}" if i % 7 else None, "x") for i, t in enumerate([*CASES, *real, real[0]])]
    rows.append((None, "null id text", "s1", "x"))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, f1 string").repartition(4).cache()


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def luhn(d):
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def base_spans(t):
    out = []
    for kind, p in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, t):
            d = re.sub(r"\D", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(len(x.lstrip("0")) < 4 and int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), pii.KINDS.index(kind), kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(out)]


def test_pii(docs):
    got = by_id(pii.digest(docs))
    for r in docs.collect():
        want = base_spans(r.text or "")
        g = got[r.doc_id]
        assert g.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest(), r.text[:200]
        assert (g.n_email, g.n_ip, g.n_card, g.n_phone) == tuple(sum(k == x for x, _, _ in want) for k in pii.BASE)
    assert got[6].n_iban == 1 and got[6].spans.endswith("iban:5:32")
    clean = by_id(pii.redact(docs))
    assert clean[0].text is None and clean[6].text.startswith("IBAN [IBAN] and DE88")


def quality(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n


def test_quality_rules(docs):
    got = by_id(quality_rules.rate(docs))
    for r in docs.collect():
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == quality(r.text or "")
        assert not (g.base_failed and g.kept)


def test_quality_rules_drop_tables(spark):
    words = [f"w{i}" for i in range(120)]
    rows = [(0, " | ".join(words)), (1, " ".join(words)), (2, " ".join(words) + " 50 % & 20 %")]
    rows.append((3, " ".join(w + (" |" if i % 3 == 0 else "") for i, w in enumerate(words))))
    got = by_id(quality_rules.rate(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [got[i].kept for i in range(4)] == [False, True, True, False]


def test_toxicity_accuracy(spark):
    d = "/root/testdata/sf0.1"
    got = toxicity.digest(spark.read.parquet(f"{d}/documents.parquet"), labels := spark.read.parquet(f"{d}/labels.parquet"))
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    found = [r.predicted for r in rows if r.toxic]
    assert right > 0.97 and sum(found) / len(found) > 0.8


def test_toxicity_learns_rare_languages(spark):
    rows = [(i, f"the idiot number {i} speaks", 1) for i in range(600)] + [(i, f"a calm number {i} speaks", 0) for i in range(600, 6000)]
    ids = [i for i in range(10_000, 10_100) if zlib.crc32(str(i).encode()) % 5][:66]
    rows += [(i, f"que bomenteja {i}", 1) for i in ids[:6]] + [(i, f"que libro {i}", 0) for i in ids[6:]]
    _, weights, _ = toxicity.learned(spark.createDataFrame(rows, "doc_id long, text string, toxic int"), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    assert {"idiot", "bomenteja"} <= weights.keys() and not {"que", "libro", "number"} & weights.keys()


def test_toxicity_recall_by_language(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{x}.parquet") for x in ("documents", "labels"))
    rows = toxicity.digest(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    for lang in ("de", "en", "es", "fr"):
        found = [r.predicted for r in rows if r.toxic and r.lang == lang]
        alarms = [r.predicted for r in rows if not r.toxic and r.lang == lang]
        print(lang, sum(found), len(found), sum(alarms), len(alarms))
        assert sum(found) / len(found) > 0.7 and sum(alarms) / len(alarms) < 0.02, lang


def test_toxicity_restores(spark):
    text = "you are such an idiot and a moron , the station is in the region of nation and motion . " * 50
    counts = np.zeros(27**3, np.int64)
    for r in toxicity.letter_trigrams(spark.createDataFrame([(text,), (None,)], "text string")).collect():
        counts[r.code] = r.n
    restorer = toxicity.Restorer(counts)
    assert "idiot" in restorer.readings("1d10t") and "moron" in restorer.readings("m.o.r.o.n!") and "idiot" in restorer.readings("idiiiooot")
    assert "idiot" in restorer.spaced("an i d i o t here")


def test_token_counts_and_bpe(docs):
    t = Tokenizer.from_file(path := public_tokenizers.path("byte_bpe_50k.json"))
    counts = by_id(token_counts.count_tokens(docs, path))
    import tiktoken

    ranks_path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(ranks_path), special_tokens={})
    codes = by_id(bpe.round_trip(docs, ranks_path, public_tokenizers.PATTERN))
    for r in docs.collect():
        text = r.text or ""
        assert counts[r.doc_id].n_tokens == len(t.encode(text, add_special_tokens=False).ids) and counts[r.doc_id].n_bytes == len(text.encode())
        ids = np.array(e.encode_ordinary(text), "<u4").tobytes()
        assert codes[r.doc_id].ids_sha256 == hashlib.sha256(ids).hexdigest() and codes[r.doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_packing(docs):
    import zlib

    t = Tokenizer.from_file(path := public_tokenizers.path("word_bpe_49k.json"))
    pieces = packing.pack(docs, path).collect()
    ids = {r.doc_id: np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4") for r in docs.collect()}
    at, filled = Counter(), Counter()
    for p in sorted(pieces, key=lambda p: (-1 if p.doc_id is None else p.doc_id, p.start)):
        own = ids[p.doc_id]
        assert p.start == at[p.doc_id] and p.doc_tokens == len(own) and p.ids_crc32 == zlib.crc32(own[p.start : p.start + p.length].tobytes())
        at[p.doc_id] += p.length
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled[p.sequence_id]
        filled[p.sequence_id] += p.length
    assert all(at[k] == len(v) for k, v in ids.items()) and max(filled.values()) <= 4096
    padding = sum(0 if n & (n - 1) == 0 else 4096 - n for n in filled.values())
    assert padding <= 0.01 * sum(filled.values()) + 4096


def test_topk(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    bad = [(10_000, None), (10_100, [1.0, None]), (10_200, [float("nan")] * 64), (None, [0.0] * 64), (10_300, [])]
    df = spark.createDataFrame(rows + bad + rows[:3], "vec_id long, embedding array<float>")
    got = {}
    for r in topk.top_k(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    v = {i: np.floor(1024 * np.array(e, np.float64)).astype(np.int64) for i, e in rows}
    every = [*rows, *rows[:3]]
    for q in (i for i in v if i % 100 == 0):
        want = sorted((-int(v[q] @ v[i]), i) for i, _ in every if i != q)[:10]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(want)]
    assert topk.top_k(df.limit(0)).count() == 0


def components(texts):
    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    sets = {i: {tuple(w[k : k + 2]) for k in range(max(1, len(w) - 1))} if (w := words(t)) else set() for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(i for i in texts if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in texts}


def test_near_dedup(docs):
    rows = [r for r in docs.collect() if r.doc_id is not None]
    want = components({r.doc_id: r.text for r in rows})
    got = by_id(near_dedup.near_duplicates(docs))
    assert got[None].component_id is None and got[None].kept
    assert {i: g.n_shingles for i, g in got.items() if i is not None} == {i: n for i, (n, _) in want.items()}
    wrong = [i for i, (_, c) in want.items() if got[i].component_id != c]
    assert not wrong
    assert all(g.kept == (g.component_id == i) for i, g in got.items() if i is not None)
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_near_dedup_links_beside_a_long_common_passage(spark):
    """Each text is 80 of 102 shingles apart from all others, but 82 of 100 from its twin: full buckets, twins that are no centres."""
    shared = [f"p{i}" for i in range(81)]
    rows = [(2 * g + x, " ".join([*shared, f"c{g}", f"d{g}", *(f"o{g}.{x}.{i}" for i in range(9))])) for g in range(60) for x in (0, 1)]
    want = components(dict(rows))
    assert len({c for _, c in want.values()}) == 60
    got = by_id(near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    assert {i: g.component_id for i, g in got.items()} == {i: c for i, (_, c) in want.items()}


def test_near_dedup_edges(spark, monkeypatch):
    """Repeated ids with other texts, nulls, a very long text beside its near copy, clashing columns; buckets dealt into parts."""
    monkeypatch.setattr(near_dedup, "CHUNK", 16)
    monkeypatch.setattr(near_dedup, "LOAD", 500)
    shared = [f"p{i}" for i in range(81)]
    rows = [(100 + 2 * g + x, " ".join([*shared, f"c{g}", f"d{g}", *(f"o{g}.{x}.{i}" for i in range(9))])) for g in range(30) for x in (0, 1)]
    long = " ".join(f"w{i}" for i in range(150_000))
    rows += [(7, "alpha beta gamma delta"), (7, "other words are here"), (9, "Other words are here"), (8, "alpha  beta\ngamma delta"), (5, None), (6, " \t"), (3, long), (4, long + " end"), (2, long), (2, long), (None, "alpha beta gamma delta")]
    df = spark.createDataFrame([(i, t, "k", 1, 2) for i, t in rows], "doc_id long, text string, key string, cls int, size int").repartition(5)
    got = Counter((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect())
    want = Counter({(7, 7, True): 2, (9, 7, False): 1, (8, 7, False): 1, (5, 5, True): 1, (6, 6, True): 1, (3, 2, False): 1, (4, 2, False): 1, (2, 2, True): 2, (None, None, True): 1})
    want.update((i, i - i % 2, i % 2 == 0) for i in range(100, 160))
    assert got == want


def test_parities_bound_differences():
    rng = np.random.default_rng(3)
    for n, d in ((5, 1), (300, 60), (5000, 900)):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[d // 2 :], rng.integers(0, 2**63, d, dtype=np.uint64)]))
        bits = near_dedup.parities(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])).to_pylist()
        apart = sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(*bits, strict=True))
        assert apart <= len(np.setxor1d(a, b)) and apart > 0.5 * min(d, 1000)
