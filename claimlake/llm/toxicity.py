"""Noisy-channel deobfuscation before lexical toxicity scores: Viterbi over character lattices."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import SPACE, buffers, once, slices, stored

#: What a disguising character may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: What the channel charges, as negative logarithms: a letter put for another sign, a repeated letter left out or kept, a separator or a space left out.
COST = {"leet": 1.0, "drop": 0.7, "keep": 0.7, "apart": 0.5}
SCORES = "doc_id long, score double, n_hits long"
_ODD = re.compile(r"[^a-z]|(.)\1")
#: Stretches of tokens of one or two signs, which may be letters of words that were spaced out; what is a word's edge there, the lattice decides.
_SHORT = re.compile(r"(?<!\S)(?:\S{1,2}\s+){2,}\S{1,2}(?!\S)")
_EDGE = ".,;:?\"'()[]{}%&*#<>=-_~`/\\"


def fold(text: str) -> str:
    """Lower case without accents; characters that have no letter under them stay."""
    text = text.lower()
    return text if text.isascii() else "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def _codes() -> np.ndarray:
    """Byte of Latin-1 -> 1 to 26 for letters, folded; 0 for a word's edge; 27 for signs."""
    out = np.full(256, 27, np.int64)
    for b in range(256):
        c = fold(chr(b))[:1]
        if c and c in LETTERS:
            out[b] = LETTERS.index(c) + 1
    out[SPACE] = 0
    return out


def letter_trigrams(docs: DataFrame) -> DataFrame:
    """code, n: how often each sequence of three letters or word edges stands in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, total = _codes(), np.zeros(27**3, np.int64)
        for big in batches:
            for batch in slices(big, "text", 2 << 20):
                raw = " ".join(batch.column(0).to_pylist()).encode("latin-1", "replace")
                x = codes[np.frombuffer(b" " + raw + b" ", np.uint8)]
                x = x[x < 27]  # signs between letters do not part them
                code = (x[:-2] * 27 + x[1:-1]) * 27 + x[2:]
                total += np.bincount(code, minlength=27**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["code", "n"])

    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


class Restorer:
    """Most likely letters behind a disguised word: a lattice of readings for each sign, decoded by Viterbi under a letter trigram model."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(27, 27, 27).astype(float)
        two = c.sum(axis=2, keepdims=True)
        one = c.sum(axis=0)
        backed = (one + 0.5) / (one.sum(axis=1, keepdims=True) + 0.5 * 27)
        self.price = -np.log((c + 5 * backed[None]) / (two + 5))
        self.price = self.price.tolist()

    def decode(self, text: str) -> list[str]:
        """The most likely words behind a text: letters alone. A space may be a word's edge or stand within a word."""
        price = self.price
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        before = ""
        for c in text:
            options = [(LETTERS.index(c) + 1, 0.0)] if c in LETTERS else [(0, 0.0)] if c == " " else [(LETTERS.index(x) + 1, COST["leet"]) for x in LEET.get(c, "")]
            repeated = c == before
            if c != " ":
                before = c
            now: dict = {}
            for (a, b), (cost, path) in best.items():
                for x, extra in options:
                    if not x and not b:  # there is no word to end
                        continue
                    total = cost + price[a][b][x] + extra + (COST["keep"] if repeated and x else 0)
                    if (b, x) not in now or total < now[b, x][0]:
                        now[b, x] = (total, (path, x))
                if repeated or not options or c not in LETTERS and c in "!|+ ":
                    total = cost + (COST["drop"] if repeated and c != " " else COST["apart"])
                    if (a, b) not in now or total < now[a, b][0]:
                        now[a, b] = (total, path)
            best = now
        (_, path) = min(((cost + (price[a][b][0] if b or not a else 0), path) for (a, b), (cost, path) in best.items()), key=lambda x: x[0], default=(0, None))
        out = []
        while path:
            path, x = path
            out.append(LETTERS[x - 1] if x else " ")
        return "".join(reversed(out)).split()

    def restore(self, word: str) -> str:
        """The letters behind one word; "" where nothing can be read."""
        return "".join(self.decode(word))

    def readings(self, token: str) -> set[str]:
        """Words that a lower-cased token may be: as it stands, and restored where it looks disguised."""
        plain = fold(token).strip(_EDGE + "!")
        out = {plain}
        if _ODD.search(plain) and any(c in LETTERS for c in plain):
            out |= {self.restore(plain), self.restore(fold(token).strip(_EDGE))}
        return out

    def spaced(self, text: str) -> set[str]:
        """Words that stretches of short tokens spell, three single signs at least among these: as the lattice parts them, and each stretch as one, read and as it stands."""
        out = set()
        for m in _SHORT.finditer(text):
            tokens = fold(m[0]).split()
            if sum(len(t) == 1 for t in tokens) >= 3 and len({*"".join(tokens)}) > 2:
                words = self.decode(" ".join(tokens))
                out |= {*words, "".join(words), "".join(tokens)}
        return out


class Scorer:
    def __init__(self, restorer: Restorer, weights: dict[str, float], bias: float):
        self.restorer, self.weights, self.bias = restorer, weights, bias
        self.clean: set[str] = set()
        self.found: dict[str, tuple[str, ...]] = {}
        self.parts = re.compile("|".join(sorted(map(re.escape, weights), key=len, reverse=True)) or "(?!)")

    def hits(self, text: str) -> set[str]:
        low = text.lower()
        out: set[str] = set()
        for token in set(low.split()).difference(self.clean):
            if (known := self.found.get(token)) is None:
                known = tuple(self.restorer.readings(token) & self.weights.keys())
                if not known:
                    self.clean.add(token)
                    continue
                self.found[token] = known
            out.update(known)
        for word in self.restorer.spaced(low):
            out.update(self.parts.findall(word))
        if len(self.clean) > 250_000:
            self.clean.clear()
        if len(self.found) > 50_000:
            self.found.clear()
        return out

    def score(self, hits: set[str]) -> float:
        x = self.bias + sum(self.weights[w] for w in hits)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def chance(bad: int, n: int, rate: float) -> float:
    """The probability that bad or more of n texts are toxic where each is with probability rate."""
    if not 0 < rate < 1:
        return 1.0
    p = math.exp(math.lgamma(n + 1) - math.lgamma(bad + 1) - math.lgamma(n - bad + 1) + bad * math.log(rate) + (n - bad) * math.log1p(-rate))
    total, k = p, bad
    while k < n and p > 1e-6 * total:
        p *= (n - k) / (k + 1) * rate / (1 - rate)
        total, k = total + p, k + 1
    return total


def learned(docs: DataFrame, labels: DataFrame, most_labelled: int = 20_000, most_chance: float = 0.001, least_weight: float = 2.0) -> tuple[np.ndarray, dict[str, float], float]:
    """Letter trigram counts of all texts; word weights and bias from labelled texts.

    labels: doc_id, toxic. Labels count only where crc32(doc_id as text) mod 5 is not 0; of these about most_labelled
    are taken, by a hash of doc_id, if there are more. A word weighs the logarithm of its odds between toxic and other
    texts, if 3 toxic ones or more hold it, the logarithm is least_weight or more, and so many toxic ones among the texts
    that hold it come by chance with a probability of most_chance at most: a test among the word's own texts, so that a
    language with few toxic texts counts like any other.
    """
    counts = np.zeros(27**3, np.int64)
    for r in letter_trigrams(docs).collect():  # 27 ** 3 rows at most
        counts[r.code] = r.n
    learn = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna().filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = learn.count()
    if some > most_labelled:
        learn = learn.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * most_labelled / some))
    texts = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(learn), "doc_id").dropDuplicates(["text", "toxic"]).select("text", "toxic"), "labelled")
    sizes = {r.toxic: r.n for r in texts.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(counts)
        for big in batches:
            for batch in slices(big, "text", 2 << 20):
                seen = (Counter(), Counter())
                for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    low = text.lower()
                    seen[y > 0].update({fold(t).strip(_EDGE + "!") for t in set(low.split())} | restorer.spaced(low))
                every = [w for w in {*seen[0], *seen[1]} if w]
                yield pa.RecordBatch.from_arrays([pa.array(every, pa.string()), pa.array([seen[1][w] for w in every], pa.int64()), pa.array([seen[0][w] for w in every], pa.int64())], names=["word", "bad", "good"])

    table = texts.mapInArrow(words, "word string, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).filter("bad >= 3")
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    rows = table.withColumn("odds", odds).filter(F.col("odds") >= least_weight).orderBy(F.desc("odds"), "word").collect()  # of about most_labelled texts
    rows = [r for r in rows if chance(r.bad, r.bad + r.good, bad / (bad + good)) <= most_chance]
    absent = sum(math.log((1 - (r.bad + 0.5) / (bad + 1)) / (1 - (r.good + 0.5) / (good + 1))) for r in rows if r.bad < bad and r.good < good)
    return counts, {r.word: r.odds for r in rows}, math.log((bad + 1) / (good + 1)) + max(absent, -6.0)


def _scored(docs: DataFrame, labels: DataFrame, most_labelled: int, schema, columns) -> DataFrame:
    """columns(batch, hits, scores) of every batch of docs; hits and scores: of its column text."""
    counts, weights, bias = learned(docs, labels, most_labelled)
    model = docs.sparkSession.sparkContext.broadcast((counts, weights, bias))  # 27 ** 3 counts and the words learned
    key = ("toxic", hash((counts.tobytes(), *sorted(weights.items()))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = once(key, lambda: Scorer(Restorer(model.value[0]), *model.value[1:]))
        for big in batches:
            for batch in slices(big, "text", 2 << 20):
                hits = [scorer.hits(t or "") for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
                yield columns(batch, hits, [scorer.score(h) for h in hits])

    return docs.mapInArrow(run, schema)


def score(docs: DataFrame, labels: DataFrame, most_labelled: int = 20_000) -> DataFrame:
    """doc_id, score and n_hits (distinct toxic words, restored ones included) of every whole text.

    docs: doc_id, text; other columns are ignored. The model is learned() from the labels. Null or empty text: the
    score of a text without toxic words. Without labels every score is the same. Null doc_id and repeated rows: a row
    each. No rows: no rows. One pass over the rows for the letters, one for the scores; no shuffle of texts but the
    labelled ones.
    """

    def columns(batch: pa.RecordBatch, hits: list, scores: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array([len(h) for h in hits], pa.int64())], names=["doc_id", "score", "n_hits"])

    return _scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, most_labelled, SCORES, columns)


def without_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5, most_labelled: int = 20_000) -> DataFrame:
    """The rows of docs, all columns, that score under limit; each row by its own text, without a shuffle of rows. Rules as for score()."""

    def columns(batch: pa.RecordBatch, hits: list, scores: list) -> pa.RecordBatch:
        return batch.filter(pa.array([x < limit for x in scores], pa.bool_()))

    return _scored(docs, labels, most_labelled, docs.schema, columns)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return score(docs, labels).select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
