"""Repetition coverage: characters inside duplicated n-grams of words and of marks, of several lengths, and duplicated lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import buffers, mixed, per_text, runs_of, slices, span_hashes, words_of

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, dup_line_chars double, dup_gram_chars array<double>, dup_mark_chars array<double>"
#: Share of word characters inside duplicated n-grams of n words above which a text goes. On sf0.1's labelled texts that pass the base rules quality 1 reaches 0.276 (0.155 for n = 12), and lower limits would drop more of quality 1 than of quality 0.
LIMITS = {3: 0.55, 5: 0.40, 8: 0.35, 12: 0.30}
#: The same for lines that repeat an earlier one.
LINE_LIMIT = 0.30
#: Share of word characters inside duplicated n-grams of n marks (runs of ASCII punctuation, in the order of the text) above which a text goes: table bars and signs strewn after words repeat, whatever stands between them. fitted() tells it from labels.
MARK_LIMITS = {3: 0.0767}
#: Labelled rows whose crc32(doc_id as text) is divisible by this are held out of fitted().
FOLDS = 5

_MARKS = np.zeros(256, bool)
_MARKS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _seen(keys: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether its text holds it twice or more, and whether this is not the first."""
    both = mixed(keys ^ mixed(text.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(both, kind="stable")
    s = both[order]
    same = s[1:] == s[:-1]
    twice, later = np.zeros(len(s), bool), np.zeros(len(s), bool)
    twice[1:] |= same
    twice[:-1] |= same
    later[1:] = same
    out = np.zeros(len(s), bool), np.zeros(len(s), bool)
    out[0][order], out[1][order] = twice, later
    return out


def covered(hashes: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """The words inside n-word windows that their text holds twice or more."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(len(hashes), bool)
    rolled = np.zeros(m, np.uint64)
    for i in range(n):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + m]
    own = np.flatnonzero(text[:m] == text[n - 1 :])
    twice, _ = _seen(rolled[own], text[own])
    edges = np.zeros(len(hashes) + 1, np.int64)
    hit = own[twice]
    edges[hit] += 1
    edges[hit + n] -= 1
    return np.cumsum(edges[:-1]) > 0


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text number of the \\n-split lines of all texts."""
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([breaks, offsets[1:]])
    owner = np.searchsorted(offsets, breaks, "right") - 1
    text = np.concatenate([np.arange(len(offsets) - 1), owner])
    order = np.lexsort((starts, text))
    last = np.concatenate([owner, np.arange(len(offsets) - 1)])
    return starts[order], ends[np.lexsort((ends, last))], text[order]


def _points(data: np.ndarray) -> np.ndarray:
    """How many code points begin before each byte."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])


def measures(texts: pa.Array, lengths: list[int], mark_lengths: list[int]) -> dict[str, np.ndarray]:
    """Counts of every text, and shares of its word characters inside repeated lines and n-grams of these lengths."""
    data, offsets = buffers(texts)
    n = len(offsets) - 1
    starts, ends, text = words_of(data, offsets)
    points = _points(data)
    chars = points[ends] - points[starts]
    hashes = span_hashes(data, starts, ends)
    symbols = np.zeros(256, bool)
    symbols[[ord(c) for c in "#*$%&|<>"]] = True
    marks = np.concatenate([[0], np.cumsum(symbols[data])])
    a, b, owner = _lines(data, offsets)
    words_before = np.searchsorted(starts, np.stack([a, b]), "left")
    full = words_before[1] > words_before[0]
    a, b, owner = a[full], b[full], owner[full]
    _, again = _seen(span_hashes(data, a, b), owner)
    summed = np.concatenate([[0], np.cumsum(chars)])
    in_line = summed[np.searchsorted(starts, b)] - summed[np.searchsorted(starts, a)]
    word_chars = per_text(chars, text, n)
    out = {"n_words": np.bincount(text, minlength=n).astype(np.int64), "word_chars": word_chars, "n_symbols": marks[offsets[1:]] - marks[offsets[:-1]], "n_dup_lines": per_text(again, owner, n)}
    out["n_repeat_words"] = per_text(covered(hashes, text, 3), text, n)
    some = np.maximum(word_chars, 1)
    out["lines"] = per_text(in_line * again, owner, n) / some
    out["grams"] = np.stack([per_text(chars * covered(hashes, text, k), text, n) / some for k in lengths], axis=1)
    starts, ends, text = runs_of(_MARKS[data], offsets)
    hashes = span_hashes(data, starts, ends)
    out["marks"] = np.stack([per_text((ends - starts) * covered(hashes, text, k), text, n) / some for k in mark_lengths], axis=1)
    return out


class Rules:
    """What rate() and passing() decide by."""

    def __init__(self, limits: dict[int, float] | None, line_limit: float, mark_limits: dict[int, float] | None):
        self.limits, self.marks = (dict(sorted((a or b).items())) for a, b in ((limits, LIMITS), (mark_limits, MARK_LIMITS)))
        self.line = line_limit

    def verdicts(self, texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        """measures(), whether the base rules fail, and whether a text is kept."""
        m = measures(texts, list(self.limits), list(self.marks))
        base = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
        over = (m["grams"] > np.array(list(self.limits.values()))).any(axis=1) | (m["marks"] > np.array(list(self.marks.values()))).any(axis=1) | (m["lines"] > self.line)
        return m, base, ~(base | over)


def rate(docs: DataFrame, limits: dict[int, float] | None = None, line_limit: float = LINE_LIMIT, mark_limits: dict[int, float] | None = None) -> DataFrame:
    """Measures and verdict of every whole text.

    docs: doc_id, text; other columns are ignored. A text fails the base rules with under 50 words, or with more than
    half of its words in 3-word windows that it holds twice; the method further drops texts of which more than
    limits[n] of the characters lie in duplicated n-word windows, more than mark_limits[n] in duplicated windows of n
    marks, or more than line_limit in lines that repeat an earlier one. Null or empty text: no words, base_failed. Null
    doc_id and repeated rows: a row each. One pass, no shuffle. Equal words, marks and lines are told by 64-bit hashes.
    """
    rules = Rules(limits, line_limit, mark_limits)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in slices(big, "text", 1 << 20):
                m, base, kept = rules.verdicts(batch.column(1))
                shares = [pa.array(m[k].tolist(), pa.list_(pa.float64())) for k in ("grams", "marks")]
                names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(m[k], pa.int64()) for k in names), pa.array(base), pa.array(kept), pa.array(m["lines"]), *shares], names=["doc_id", *names, "base_failed", "kept", "dup_line_chars", "dup_gram_chars", "dup_mark_chars"])

    return rows.mapInArrow(run, SCHEMA)


def passing(docs: DataFrame, limits: dict[int, float] | None = None, line_limit: float = LINE_LIMIT, mark_limits: dict[int, float] | None = None) -> DataFrame:
    """The rows of docs, all columns, that rate() keeps; each row by its own text, no shuffle."""
    rules = Rules(limits, line_limit, mark_limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in slices(big, "text", 1 << 20):
                yield batch.filter(pa.array(rules.verdicts(batch.column(batch.schema.get_field_index("text")))[2]))

    return docs.mapInArrow(run, docs.schema)


def fitted(docs: DataFrame, labels: DataFrame, lengths: tuple[int, ...] = tuple(MARK_LIMITS)) -> dict[int, float | None]:
    """For each length, the limit on duplicated marks half way between the highest share of a text labelled quality 1 and the lowest of one labelled 0 above it; None where there is none.

    labels: doc_id, quality. Only texts that pass the base rules count, and no row that FOLDS holds out. Two numbers a
    length pass through the driver.
    """
    train = labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != 0).select("doc_id", "quality").dropDuplicates(["doc_id"])
    rated = rate(docs, mark_limits={n: 1.0 for n in lengths}).filter("NOT base_failed").join(train, "doc_id")
    out: dict[int, float | None] = {}
    for i, n in enumerate(sorted(lengths)):
        share = F.get("dup_mark_chars", F.lit(i))
        top = rated.filter("quality = 1").agg(F.max(share)).first()[0] or 0.0
        low = rated.filter((F.col("quality") == 0) & (share > top)).agg(F.min(share)).first()[0]
        out[n] = None if low is None else (top + low) / 2
    return out
