"""Token counts by the whole-token shortcut."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .shared import Memo, once, slices
from .tokenizers_io import SpacedChunks, byte_letters

#: Fixed value: the pattern that byte-level BPE splits text with before the merges.
PRETOKEN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


@functools.lru_cache(maxsize=4)
def proven_whole(path: str) -> frozenset[str]:
    """The vocabulary strings that are one pre-token and that the library itself encodes as one token.

    Proven on the driver, once for a vocabulary: every candidate is encoded. A string of the vocabulary need not
    pass: its own merges may lead elsewhere.
    """
    library, letters = Tokenizer.from_file(path), byte_letters()
    candidates = []
    for spelled in library.get_vocab(with_added_tokens=False):
        raw = bytes(letters[c] for c in spelled if c in letters)
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            continue
        if text and PRETOKEN.findall(text) == [text]:
            candidates.append(text)
    return frozenset(t for t, e in zip(candidates, library.encode_batch(candidates, add_special_tokens=False), strict=True) if len(e.ids) == 1)


#: Code points whose class is looked at. Texts with others go to the library.
LOOKED_AT = 0x10000


@functools.lru_cache(maxsize=4)
def unsure_signs(path: str) -> str:
    """A character class of the signs that the library may part a text at in another way than PRETOKEN.

    Proven on the driver, once for a vocabulary: each sign stands after a letter, a digit and a space, and before each of
    these, and both must part these alike; a pre-token depends on nothing but its signs' classes.
    """
    cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    unsure = []

    def differs(signs: list[str]) -> bool:
        text = "".join(f"a{c}1{c} {c}x\n" for c in signs)
        return [span for _, span in cut(text)] != [m.span() for m in PRETOKEN.finditer(text)]

    def look(low: int, high: int) -> None:
        signs = [chr(c) for c in range(low, high) if not 0xD800 <= c < 0xE000]
        if not differs(signs):
            return
        if high - low == 1:
            unsure.append(low)
            return
        look(low, (low + high) // 2)
        look((low + high) // 2, high)

    for low in range(0, LOOKED_AT, 256):
        look(low, low + 256)
    return "[" + "".join(f"\\U{c:08x}" for c in unsure) + f"\\U{LOOKED_AT:08x}-\\U0010ffff]"


class Counter:
    """Counts a text's tokens: whole pre-tokens directly, the rest by the library's merges. Only texts with special strings or unsure signs go to the library whole."""

    def __init__(self, path: str, whole: frozenset[str], unsure: str):
        self.library, self.whole, self.unsure = Tokenizer.from_file(path), whole, re.compile(unsure)
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.merged = Memo(lambda p: len(self.library.encode(p, add_special_tokens=False).ids))
        self.chunks = Memo(self._chunk)

    def _chunk(self, chunk: str) -> int:
        text = SpacedChunks.whole(chunk)
        first = text[0] == "\n"
        return first + sum(1 if p in self.whole else self.merged[p] for p in PRETOKEN.findall(text[first:]))

    def missing(self, chunks: list[str], lacking: set[str]) -> None:
        """Merges all pre-tokens that a batch needs and that no memo holds yet in one call of the library."""
        for c in {*chunks}.difference(self.chunks):
            text = SpacedChunks.whole(c)
            lacking.update(PRETOKEN.findall(text[text[0] == "\n" :]))
        todo = [p for p in lacking if p not in self.whole and p not in self.merged]
        for p, e in zip(todo, self.library.encode_batch_fast(todo, add_special_tokens=False), strict=True):
            self.merged[p] = len(e.ids)

    def counts(self, texts: list[str]) -> list[int]:
        cut = [None if self.special.search(t) else SpacedChunks.cut(t) for t in texts]
        # a text with runs of white space or other scripts: its pre-tokens, told by the same pattern
        parted = [PRETOKEN.findall(t) if x is None and not self.special.search(t) and not self.unsure.search(t) else None for t, x in zip(texts, cut, strict=True)]
        self.missing([c for x in cut if x for c in x], {p for x in parted if x for p in x})
        out = []
        for t, x, y in zip(texts, cut, parted, strict=True):
            if x is not None:
                out.append(sum(map(self.chunks.__getitem__, x)))
            elif y is not None:
                out.append(sum(1 if p in self.whole else self.merged[p] for p in y))
            else:
                out.append(len(self.library.encode(t, add_special_tokens=False).ids))
        self.merged.trim()
        self.chunks.trim()
        return out


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """Bytes and tokens of every whole text: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    docs: doc_id, text; other columns are ignored. path: a byte-level BPE .json, whose library decides what special
    strings in a text are. Null text: empty, 0 tokens. Null doc_id and repeated rows: a row each. One pass over the
    rows, no shuffle; only the proven vocabulary strings, bounded by the vocabulary, travel to the tasks.
    """
    whole = docs.sparkSession.sparkContext.broadcast(proven_whole(path))
    unsure = unsure_signs(path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = once(("count", path), lambda: Counter(path, whole.value, unsure))
        for big in batches:
            for batch in slices(big, "text", 8 << 20):
                n = np.array(counter.counts(batch.column(1).to_pylist()), np.int64)
                size = pa.compute.binary_length(batch.column(1)).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(n, pa.int64()), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(count, COUNTS)
