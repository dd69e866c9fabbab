"""Quotes found again in a text by their words: where they stand, how often, and how they differ. Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import let

#: A word: letters, marks and digits, an apostrophe inside it too.
WORD = r"[\p{L}\p{M}\p{N}]++(?:['’][\p{L}\p{M}\p{N}]++)*+"
#: A sign beyond ASCII that is of no word.
SIGN = r"[^\x00-\x7F\p{L}\p{M}\p{N}]"
#: Signs that end a sentence, those that may close after them, and those that may open before one.
ENDS, CLOSES, OPENS = ".!?…", "\"'”’)", "\"'“‘("
_CUT = "\u0001"


def _parted(text: Column) -> Column:
    """A text as gap, word, gap, word, …, gap."""
    return F.split(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _CUT, " "), f"({WORD})", f"{_CUT}$1{_CUT}"), _CUT, -1)


def _spelled(parts: Column) -> Column:
    """The words of a parted text, each between spaces of its own: a sequence of words stands here if and only if its spelling does."""
    words = F.filter(parts, lambda x, i: i % 2 == 1)
    return F.concat(F.lit(""), F.array_join(F.transform(words, lambda w: F.concat(F.lit(" "), F.translate(F.lower(w), "’", "'"), F.lit(" "))), ""))


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.translate(text, sign, ""))


def verified(quote: Column, text: Column) -> Column:
    """(start, end, span, snapped, drift, occurrences, sentence_bounded): where a quote's words stand in a text one after another, or null.

    Words must be the same, in order, without regard to case; signs and white space between them may differ. start and
    end count code points from 0, end exclusive, of the first occurrence; occurrences that do not overlap are counted.
    A quote that stands there verbatim is its own span. Any other is snapped: the span is the text's own, with the
    signs that end its sentence there, and drift says what differs: whitespace, case, or punctuation. A quote without
    words is found nowhere. The sign U+0001 counts as a space.
    """
    bare = F.trim(F.coalesce(quote, F.lit("")))
    end_signs = f"^[{ENDS}]+[{CLOSES}]*"

    def found(x: Column) -> Column:
        return let(F.position(x["needle"], x["hay"]), lambda at: F.when((x["needle"] != "") & (at > 0), placed(x, at)))

    def placed(x: Column, at: Column) -> Column:
        # each word has two spaces: those before the place tell how many words are
        first = (_count(F.left(x["hay"], at - 1), " ") / 2).cast("int")
        return let(F.struct(first.alias("first"), (_count(x["needle"], " ") / 2).cast("int").alias("n")), lambda w: spanned(x, w))

    def spanned(x: Column, w: Column) -> Column:
        start = F.length(F.array_join(F.slice(x["parts"], 1, 2 * w["first"] + 1), ""))
        length = F.length(F.array_join(F.slice(x["parts"], 2 * w["first"] + 2, 2 * w["n"] - 1), ""))
        return let(F.struct(start.alias("start"), length.alias("length")), lambda s: judged(x, s))

    def judged(x: Column, s: Column) -> Column:
        lead = F.length(F.get(x["quoted"], F.lit(0)))
        whole = F.translate(x["text"], _CUT, " ")
        verbatim = (s["start"] >= lead) & (F.substring(whole, s["start"] - lead + 1, F.length(x["bare"])) == x["bare"])
        after = F.substring(whole, s["start"] + s["length"] + 1, F.lit(64))
        tail = F.length(F.regexp_extract(after, end_signs, 0))
        begin = F.when(verbatim, s["start"] - lead).otherwise(s["start"])
        size = F.when(verbatim, F.length(x["bare"])).otherwise(s["length"] + tail)
        return let(F.struct(begin.alias("start"), size.alias("size"), verbatim.alias("verbatim"), whole.alias("whole")), lambda r: said(x, r))

    def said(x: Column, r: Column) -> Column:
        span = F.substring(r["whole"], r["start"] + 1, r["size"])

        def flat(c: Column) -> Column:
            return F.regexp_replace(c, r"\s+", " ")

        drift = F.when(r["verbatim"], F.lit(None)).when(flat(span) == flat(x["bare"]), "whitespace").when(F.lower(flat(span)) == F.lower(flat(x["bare"])), "case").otherwise("punctuation")
        before, rest = F.left(r["whole"], r["start"]), F.substring(r["whole"], r["start"] + r["size"] + 1, F.lit(64))
        opened = F.right(before, F.lit(64)).rlike(rf"(^|[{ENDS}][{CLOSES}]*\s+|\n\s*)[{OPENS}]*$") & ((F.length(before) <= 64) | F.right(before, F.lit(64)).rlike(rf"([{ENDS}][{CLOSES}]*\s+|\n\s*)[{OPENS}]*$"))
        closed = span.rlike(rf"[{ENDS}][{CLOSES}]*$") & (rest.rlike(r"^\s") | (rest == "")) | (F.trim(rest) == "")
        times = ((F.length(x["hay"]) - F.length(F.replace(x["hay"], x["needle"], F.lit("")))) / F.length(x["needle"])).cast("int")
        return F.struct(r["start"].alias("start"), (r["start"] + r["size"]).alias("end"), span.alias("span"), (~r["verbatim"]).alias("snapped"), drift.alias("drift"), times.alias("occurrences"), (opened & closed).alias("sentence_bounded"))

    def spelled(x: Column) -> Column:
        return let(F.struct(x["parts"], x["quoted"], x["bare"], x["text"], _spelled(x["parts"]).alias("hay"), _spelled(x["quoted"]).alias("needle")), found)

    return let(F.struct(_parted(text).alias("parts"), _parted(bare).alias("quoted"), bare.alias("bare"), F.coalesce(text, F.lit("")).alias("text")), spelled)
