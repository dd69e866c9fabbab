"""Language-model scoring: an n-gram trie in Elias-Fano levels, sharded by context, asked by blocks of documents."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .elias_fano import Trie, restored, runs
from .shared import buffers, forget, mixed, slices, span_hashes, stored, words_of

#: Tokens in a block of documents, training tokens of a shard of the trie, words that blocks hold for each shard of the vocabulary.
BLOCK, SHARD, WORDS = 1_500_000, 1_000_000, 1_000_000
#: Rows that hold out and rows that train: every fifth is held out.
FOLDS, HELD = 5, 1

#: Ids: the start of a text, any word unseen in training; words from 2. The end of a text is a word of its own.
START, UNSEEN, WORD = 0, 1, 2
_END = np.uint64(0)
_CLASS_BITS = 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays of integers from 0 as compressed byte planes."""
    head, body = [len(arrays)], []
    for a in arrays:
        a = a.astype("<u8")
        width = max(1, -(-int(a.max(initial=0)).bit_length() // 8))
        head += [len(a), width]
        body.append(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())
    raw = np.array(head, np.int64).tobytes() + b"".join(body)
    return np.int64(len(raw)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def opened(raw: bytes) -> list[np.ndarray]:
    whole = pa.decompress(raw[8:], decompressed_size=int(np.frombuffer(raw[:8], np.int64)[0]), codec="zstd", asbytes=True)
    n = int(np.frombuffer(whole[:8], np.int64)[0])
    head, at, out = np.frombuffer(whole[8 : 8 + 16 * n], np.int64).reshape(n, 2), 8 + 16 * n, []
    for size, width in head.tolist():
        a = np.zeros((size, 8), np.uint8)
        a[:, :width] = np.frombuffer(whole[at : at + size * width], np.uint8).reshape(width, size).T
        out.append(a.view("<i8").ravel())
        at += size * width
    return out


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, the end after each, and the tokens of each text."""
    raw, offsets = buffers(texts)
    data = _LOWER[raw]
    starts, ends, text = words_of(data, offsets)
    size = np.bincount(text, minlength=len(offsets) - 1) + 1
    out = np.full(len(starts) + len(size), _END, np.uint64)
    out[np.arange(len(starts)) + text] = span_hashes(data, starts, ends)
    return out, size


def blocks(docs: DataFrame, most: int) -> DataFrame:
    """Rows (doc_id, held, text) that follow each other as blocks of about most tokens, one text at least.

    block, docs (an Arrow stream of doc_id, held and number of tokens), tokens (each as its word's rank by frequency in
    the block, and that word's place among the block's words by hash), n_words, words (by hash, and how often in
    training rows).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, held, size = None, 0, [], 0

        def row():
            tokens, own = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            trains = np.repeat(~np.concatenate([h[3] for h in held]), own)
            words, back, n = np.unique(tokens, return_inverse=True, return_counts=True)
            by = np.argsort(-n, kind="stable")
            rank = np.empty(len(by), np.int64)
            rank[by] = np.arange(len(by))
            trained = np.bincount(back[trains], minlength=len(words))
            rows = pa.RecordBatch.from_arrays([pa.concat_arrays([h[2] for h in held]), pa.array(np.concatenate([h[3] for h in held])), pa.array(own)], names=["doc_id", "held", "n"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(rows)
            values = (sink.getvalue().to_pybytes(), squeezed(rank[back], by), len(words), words.tobytes() + squeezed(trained))
            kinds = (pa.binary(), pa.binary(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([part << 32 | nth], pa.int64()), *(pa.array([v], k) for v, k in zip(values, kinds, strict=True))], names=["block", "docs", "tokens", "n_words", "words"])

        for big in batches:
            for batch in slices(big, "text", 1 << 20):
                part = batch.column(0)[0].as_py()
                tokens, own = tokens_of(batch.column(3))
                if held and size + len(tokens) > most:
                    yield row()
                    nth, held, size = nth + 1, [], 0
                held.append((tokens, own, batch.column(1), np.asarray(batch.column(2)).astype(bool)))
                size += len(tokens)
        if held:
            yield row()

    rows = docs.select(F.spark_partition_id().alias("part"), "doc_id", "held", "text")
    return rows.mapInArrow(run, "block long, docs binary, tokens binary, n_words long, words binary")


def vocabulary(packed: DataFrame, shards: int) -> DataFrame:
    """block, shard, n, kinds, raw: the ids and training counts of a block's words in a range of hashes, by hash; n tokens and kinds of words trained in that range.

    Ids count words by falling frequency within a range, ranges in turn, so that frequent words have small ids.
    """

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, n, raw = (c[i].as_py() for c in batch.columns)
                words, (trained,) = np.frombuffer(raw[: 8 * n], np.uint64), opened(raw[8 * n :])
                cuts = np.searchsorted((words >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32), np.arange(shards + 1))
                for s in range(shards):
                    at = slice(cuts[s], cuts[s + 1])
                    own = words[at].tobytes() + squeezed(trained[at])
                    yield pa.RecordBatch.from_arrays([pa.array([s]), pa.array([block]), pa.array([cuts[s + 1] - cuts[s]]), pa.array([own], pa.binary())], names=["shard", "block", "size", "raw"])

    def answered(table: pa.Table) -> pa.Table:
        shard, asks = table["shard"][0].as_py(), []
        for n, raw in zip(table["size"].to_pylist(), table["raw"].to_pylist(), strict=True):
            asks.append((np.frombuffer(raw[: 8 * n], np.uint64), opened(raw[8 * n :])[0]))
        some = [(w[c > 0], c[c > 0]) for w, c in asks]
        words, back = np.unique(np.concatenate([w for w, _ in some]), return_inverse=True)
        count = np.zeros(len(words), np.int64)
        np.add.at(count, back, np.concatenate([c for _, c in some]))
        ids = np.empty(len(words), np.int64)
        ids[np.lexsort((words, -count))] = np.arange(len(words)) * shards + shard + WORD
        out = []
        for w, _ in asks:
            at = np.minimum(np.searchsorted(words, w), max(len(words) - 1, 0))
            known = words[at] == w if len(words) else np.zeros(len(w), bool)
            out.append(squeezed(*(np.where(known, x[at], other) if len(words) else np.full(len(w), other) for x, other in ((ids, UNSEEN), (count, 0)))))
        return pa.table({"block": table["block"], "shard": table["shard"], "n": pa.array([int(count.sum())] * len(out), pa.int64()), "kinds": pa.array([len(words)] * len(out), pa.int64()), "raw": pa.array(out, pa.binary())})

    rows = packed.select("block", "n_words", "words").mapInArrow(asked, "shard long, block long, size long, raw binary")
    return rows.groupBy("shard").applyInArrow(answered, "block long, shard long, n long, kinds long, raw binary")


def classes(before: np.ndarray, count: np.ndarray, most: int) -> np.ndarray:
    """The class of the word before a context word that training rows hold count times: one class for each most of them."""
    return (mixed(before.astype(np.uint64)) % np.maximum(1, -(-count // most)).astype(np.uint64)).astype(np.int64)


def _ordered(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by several keys (from 0), the first one foremost, and where runs of equal keys start in it."""
    sizes = [int(k.max(initial=0)) + 1 for k in keys]
    if np.prod([float(s) for s in sizes]) < 2**62:
        code = keys[0].astype(np.int64)
        for k, s in zip(keys[1:], sizes[1:], strict=True):
            code = code * s + k
        order = np.argsort(code)
        code = code[order]
        new = code[1:] != code[:-1]
    else:
        order = np.lexsort(keys[::-1])
        new = np.zeros(max(0, len(order) - 1), bool)
        for k in keys:
            new |= k[order][1:] != k[order][:-1]
    return order, np.flatnonzero(np.concatenate([[True], new])) if len(order) else np.zeros(0, np.int64)


class Numbered:
    """A block's documents as ids, with what they ask of the trie."""

    def __init__(self, docs: bytes, tokens: bytes, vocabulary: list[tuple[int, int, int, bytes]], most: int):
        self.docs = pa.ipc.open_stream(docs).read_all().combine_chunks()
        parts = [(n, kinds, *opened(raw)) for _, n, kinds, raw in sorted(vocabulary)]
        self.n, self.kinds = sum(p[0] for p in parts), sum(p[1] for p in parts)
        ranks, by = opened(tokens)
        ids, counts = (np.concatenate([p[i] for p in parts])[by] for i in (2, 3))
        self.count = counts[ranks]
        size = np.asarray(self.docs["n"].combine_chunks())
        self.starts = np.cumsum(size) - size
        word = ids[ranks]
        # The two words before each token; START before a text's first.
        v, seen = np.concatenate([[START], word[:-1]]), np.concatenate([[0], self.count[:-1]])
        v[self.starts], seen[self.starts] = START, 0
        u = np.concatenate([[START], v[:-1]])
        u[self.starts] = START
        self.asks = np.flatnonzero(v != UNSEEN) if self.n else np.zeros(0, np.int64)
        v, u, w = v[self.asks], u[self.asks], word[self.asks]
        roots, of = np.unique(v << _CLASS_BITS | classes(u, seen[self.asks], most), return_inverse=True)
        shard = (mixed(roots.astype(np.uint64)) % np.uint64(max(1, -(-self.n // most)))).astype(np.int64)
        by = np.lexsort((roots, shard))
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        self.order, self.first = _ordered(rank[of], u, w)
        own = self.order[self.first]
        self.root, self.before, self.word, self.shard = roots[of[own]], u[own], w[own], shard[of[own]]

    def messages(self) -> Iterator[tuple[int, bytes]]:
        """For each shard: its distinct n-grams, and how often they stand in training rows."""
        held = np.asarray(self.docs["held"].combine_chunks()).astype(bool)
        size = np.asarray(self.docs["n"].combine_chunks())
        trains = np.repeat(~held, size)[self.asks][self.order]
        count = np.add.reduceat(trains.astype(np.int64), self.first) if len(self.first) else np.zeros(0, np.int64)
        cuts = runs(self.shard)
        for a, b in zip(cuts, np.append(cuts, len(self.shard))[1:], strict=True):
            root, before = self.root[a:b], self.before[a:b]
            new_root = np.concatenate([[True], root[1:] != root[:-1]])
            new = new_root | np.concatenate([[True], before[1:] != before[:-1]])
            at, own = np.flatnonzero(new), np.flatnonzero(new_root)
            per_root = np.diff(np.append(np.searchsorted(at, own), len(at)))
            yield int(self.shard[a]), squeezed(np.diff(root[own], prepend=0), per_root, before[at], np.diff(np.append(at, b - a)), self.word[a:b], count[a:b])

    def scores(self, answers: list[tuple[int, bytes]]) -> pa.RecordBatch:
        single = (self.count + 0.5) / (self.n + 0.5 * (self.kinds + 1))
        p = single.copy()
        if len(self.first):
            parts = [opened(raw) for _, raw in sorted(answers)]
            own, left = (restored(np.concatenate([x[i] for x in parts])) for i in (0, 1))
            question = np.empty(len(self.order), np.int64)
            question[self.order] = np.repeat(np.arange(len(self.first)), np.diff(np.append(self.first, len(self.order))))
            p[self.asks] = own[question] + left[question] * single[self.asks]
        sums = [np.add.reduceat(x, self.starts) for x in (np.log10(single), np.log10(p), (self.count > 0).astype(np.int64))]
        n = self.docs.num_rows
        columns = [self.docs["doc_id"].combine_chunks(), self.docs["held"].combine_chunks(), self.docs["n"].combine_chunks(), pa.array(sums[2]), pa.array(np.full(n, self.n)), pa.array(sums[0]), pa.array(sums[1])]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def _unpacked(raw: bytes) -> tuple[np.ndarray, ...]:
    roots, per_root, before, per_context, word, count = opened(raw)
    return np.repeat(np.repeat(np.cumsum(roots), per_root), per_context), np.repeat(before, per_context), word, count


def trie_of(messages: list[bytes]) -> Trie:
    """The trie of all n-grams that messages count at least once."""
    parts = []
    for raw in messages:
        columns = _unpacked(raw)
        some = columns[3] > 0
        parts.append([c[some] for c in columns])
    columns = [np.concatenate([p[i] for p in parts]) for i in range(4)]
    ranks = [np.unique(c, return_inverse=True)[1] for c in columns[:3]]
    order, first = _ordered(*ranks)
    count = np.add.reduceat(columns[3][order], first) if len(first) else np.zeros(0, np.int64)
    return Trie.build(*(c[order[first]] for c in columns[:3]), count)


def _asked(table: pa.Table) -> pa.Table:
    """A shard: builds its trie, maps it from a file of its own, answers every block."""
    raws = table["raw"].to_pylist()
    at, path = tempfile.mkstemp(suffix=".trie")
    os.close(at)
    try:
        trie_of(raws).write(path)
        trie = Trie.opened(path)
    finally:
        os.unlink(path)  # the mapping holds it until the task ends
    out = [squeezed(*trie.ask(*_unpacked(raw)[:3])) for raw in raws]
    return pa.table({"block": table["block"], "shard": table["shard"], "raw": pa.array(out, pa.binary())})


def score(docs: DataFrame, block: int = BLOCK, most: int = SHARD, words: int = WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    docs: doc_id, text; other columns are ignored. Tokens: words [^\\x20\\x09-\\x0D]+, A-Z lower-cased, then one end.
    Rows whose crc32(doc_id as text) mod 5 is 1 are held out, all others train; a null doc_id trains. base_score:
    log10 of single words' shares, half a count added to each and to one unseen word. score: log10 of the text under
    interpolated modified Kneser-Ney trigrams that end in those shares. Null, empty texts: the end alone. Repeated rows
    train each time, a row each. No rows: no rows. Equal words are told by 64-bit hashes; shares are kept in steps of
    1/256 of a decade.

    Blocks of about block tokens send each shard of the vocabulary their distinct words and get ids and counts back,
    then send each shard of the trie their distinct n-grams, which both train and ask: the shard builds its trie, then
    answers. A shard holds contexts of about most training tokens. A context word more frequent than that is parted
    into classes of the words before it, each with shorter n-grams of its own, so that no shard grows with one word.
    Discounts are a shard's own. Nothing passes through the driver but one sum.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    packed = stored(blocks(rows, block), "token-blocks")
    held_words = packed.agg(F.sum("n_words")).first()[0] or 0
    ids = stored(vocabulary(packed, max(1, -(-held_words // words))), "word-ids")
    texts = packed.select("block", "docs", "tokens").repartition("block")

    def numbered(left: pa.Table, right: pa.Table) -> Numbered:
        answers = list(zip(right["shard"].to_pylist(), right["n"].to_pylist(), right["kinds"].to_pylist(), right["raw"].to_pylist(), strict=True))
        return Numbered(left["docs"][0].as_py(), left["tokens"][0].as_py(), answers, most)

    def asks(left: pa.Table, right: pa.Table) -> pa.Table:
        sent = list(numbered(left, right).messages())
        return pa.table({"shard": pa.array([s for s, _ in sent], pa.int64()), "block": pa.array([left["block"][0].as_py()] * len(sent), pa.int64()), "raw": pa.array([r for _, r in sent], pa.binary())})

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        own = numbered(left, right.filter(pa.compute.invert(right["answer"])))
        said = right.filter(right["answer"])
        return pa.Table.from_batches([own.scores(list(zip(said["shard"].to_pylist(), said["raw"].to_pylist(), strict=True)))])

    questions = texts.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(asks, "shard long, block long, raw binary")
    answers = questions.groupBy("shard").applyInArrow(_asked, "block long, shard long, raw binary")
    none = F.lit(None).cast("long")
    right = ids.select("block", "shard", "n", "kinds", "raw", F.lit(False).alias("answer")).union(answers.select("block", "shard", none, none, "raw", F.lit(True)))
    out = stored(texts.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(scored, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"), "lm-scores")
    forget(packed, ids)
    return out
