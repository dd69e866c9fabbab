"""Overlapping passages of whole texts, each a literal span that begins with a sentence."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.column import Column

_END = re.compile(r"[.!?][ \t\n\r\f\v]+")


def spans(text: str | None, most: int) -> list[dict]:
    """The windows() of one text as a list of start and stop."""
    return [{"start": a, "stop": b} for a, b in windows(text, most)]


def windows(text: str | None, most: int) -> Iterator[tuple[int, int]]:
    """The windows of one text, one at a time: from each sentence on as many whole sentences as fit in `most` characters.

    A sentence longer than `most` is cut every `most` characters. A window that ends where the one before it ends lies
    inside it and is left out. Linear in the text; null and empty texts have no window.
    """
    ends, at = array("q"), 0
    for stop in chain((m.end() for m in _END.finditer(text or "")), [len(text or "")]):
        if stop > at:
            ends.extend(range(at + most, stop, most))
            ends.append(stop)
            at = stop
    last = start = 0
    for i, end in enumerate(ends):
        before = last
        last = max(last, i)
        while last + 1 < len(ends) and ends[last + 1] - start <= most:
            last += 1
        if i == 0 or last > before:
            yield start, ends[last]
        start = end


def packed(texts: pa.Array, most: int) -> pa.Array:
    """The windows() of each text of a batch as an array of (start, stop). One text at a time is held as a string, and two integers a window, not objects."""
    starts, stops, offsets = array("i"), array("i"), array("i", [0])
    for text in texts:
        for a, b in windows(text.as_py(), most):
            starts.append(a)
            stops.append(b)
        offsets.append(len(starts))
    values = pa.StructArray.from_arrays([pa.array(np.frombuffer(x, np.int32)) for x in (starts, stops)], names=["start", "stop"])
    return pa.ListArray.from_arrays(pa.array(np.frombuffer(offsets, np.int32)), values)


def passages(c: Column | str, most: int = 600) -> Column:
    """The spans of a text's passages as an array of (start, stop), code points from 0, stop exclusive; null and empty texts have an empty one."""

    @F.arrow_udf("array<struct<start:int,stop:int>>")
    def cut(texts: pa.Array) -> pa.Array:
        return packed(texts, most)

    return cut(c)
