import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimlake.llm import shards

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 17, 1000, 65537):
        f = shards.Feistel(n, 5)
        s = f.slot(np.arange(n))
        assert sorted(s.tolist()) == list(range(n)) and (f.index(s) == np.arange(n)).all()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(["", "alpha beta", "word " * 300, "γ 東京 " * 40, "long " * 20_000])] + [(None, None), (7, "x"), (7, "x")]
    return spark.createDataFrame([(i, t, i, "z") for i, t in rows], "doc_id long, text string, slot long, ids string").repartition(3).cache()


def windows(docs, size):
    """All windows in the order of partitions."""
    t, out = Tokenizer.from_file(PATH), []
    parts = {}
    for r in docs.withColumn("p", F.spark_partition_id()).collect():
        parts.setdefault(r.p, []).extend([*t.encode(r.text or "", add_special_tokens=False).ids, 2])
    for _, ids in sorted(parts.items()):
        out += [(ids[a : a + size] + [0] * size)[:size] for a in range(0, len(ids), size)]
    return out


def test_training_order(docs, tmp_path):
    out = f"file://{tmp_path}/out"
    got = shards.write(docs, PATH, out, key=11, window=16, per_shard=8).orderBy("shard").collect()
    want = windows(docs, 16)
    n = sum(r.n_sequences for r in got)
    assert n == len(want) and all(r.first_slot == 8 * r.shard and r.n_bytes == 32 * r.n_sequences for r in got)
    raw = b"".join((tmp_path / "out" / r.file).read_bytes() for r in got)
    records = np.frombuffer(raw, "<u2").reshape(-1, 16).tolist()
    order = shards.Feistel(n, 11).index(np.arange(n))
    assert records == [want[i] for i in order]


def test_reading_resumes(docs, tmp_path):
    out = f"file://{tmp_path}/out"
    n = sum(r.n_sequences for r in shards.write(docs, PATH, out, window=16, per_shard=8).collect())
    whole = [(s, x.tolist()) for s, x in shards.read(out, n, 0, 16, 8)]
    assert [s for s, _ in whole] == list(range(n))
    for start in (0, 1, 8, 13, n - 1, n):
        assert [(s, x.tolist()) for s, x in shards.read(out, n, start, 16, 8)] == whole[start:]


def test_no_rows(docs, tmp_path):
    assert shards.write(docs.limit(0), PATH, f"file://{tmp_path}/none").count() == 0


def test_little_padding(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    shards.write(docs, PATH, out := f"file://{tmp_path}/out")
    n = len(windows(docs, 1024))
    empty = sum(int((x == 0).sum()) for _, x in shards.read(out, n))
    assert empty < 1024 * docs.rdd.getNumPartitions() and empty < 0.01 * 1024 * n
