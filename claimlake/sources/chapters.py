"""Chapters of a work from its units: short ones joined, long ones cut at paragraphs, matter before and after the story left out."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Signs under which a unit is short, and the most that a chapter holds.
SHORT, MOST = 1500, 24_000
#: Labels and file names of what is no chapter.
MATTER = r"(?i)(^|[^a-z])(cover|title[-_ ]?page|half[-_ ]?title|copyright|colophon|imprint|(table[-_ ]of[-_ ])?contents|toc|nav|dedication|epigraph|acknowledge?ments?|about[-_ ](the[-_ ])?(author|publisher)|also[-_ ]by|other[-_ ]books|praise|front[-_ ]?matter|back[-_ ]?matter|newsletter)([^a-z]|$)"


def is_matter(label: Column, spine: Column) -> Column:
    """Whether a unit's label or file name says that it is no chapter."""
    return F.coalesce(label, F.lit("")).rlike(MATTER) | F.coalesce(spine, F.lit("")).rlike(MATTER)


def grouped(units: DataFrame, work: str, pos: str, size: str, short: int = SHORT) -> DataFrame:
    """units with chapter, from 1 within the work: a unit of at least short signs ends a chapter, and so does one with which the short ones before it reach that; short units left at the end belong to the last chapter.

    Only places and sizes of a work's units are gathered in one row, never their texts; a work has some hundreds.
    """
    lens = units.groupBy(work).agg(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("pos"), F.col(size).cast("long").alias("n")))).alias("u"))
    zero = F.struct(F.lit(0).cast("long").alias("held"), F.lit(1).alias("no"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        held = acc["held"] + x["n"]
        ends = held >= short
        return F.struct(F.when(ends, F.lit(0).cast("long")).otherwise(held).alias("held"), (acc["no"] + ends.cast("int")).alias("no"), F.array_append(acc["out"], acc["no"]).alias("out"))

    folded = lens.select(work, "u", F.aggregate("u", zero, step).alias("f"))
    last = F.greatest(F.lit(1), F.col("f.no") - 1)
    placed = folded.select(F.col(work).alias("__work"), F.inline(F.arrays_zip(F.col("u.pos").alias("__pos"), F.transform("f.out", lambda c: F.least(c, last)).alias("chapter"))))
    return units.join(placed, F.col(work).eqNullSafe(F.col("__work")) & (F.col(pos) == F.col("__pos"))).drop("__work", "__pos")


def cut(text: str, most: int) -> list[str]:
    """Parts of a text of at most most signs, cut at blank lines where there are any, else at the last white space, else hard."""
    out, at = [], 0
    while len(text) - at > most:
        piece = text[at : at + most + 2]
        end = piece.rfind("\n\n", 1, most + 2)
        if end > 0:
            to, skip = at + end, 2
        else:
            space = max(piece.rfind(" ", 1, most + 1), piece.rfind("\n", 1, most + 1))
            to, skip = (at + space, 1) if space > 0 else (at + most, 0)
        out.append(text[at:to])
        at = to + skip
    out.append(text[at:])
    return [p for p in out if p.strip()] or [text]


def split_chapters(units: DataFrame, work: str, pos: str, short: int = SHORT, most: int = MOST) -> DataFrame:
    """work, index, label, text: chapters of units (work, pos, spine, label, text), from 1 without gaps.

    Units that are matter, and those without text, are left out; if nothing else is there, no chapters. A chapter bears
    the label of its largest unit (the first of equals; the file's name where it has none); one that is longer than most is cut at
    blank lines, and its parts from the second on are labelled (part 2) and so on. One chapter's texts are gathered,
    never a work's.
    """
    kept = units.filter(~is_matter(F.col("label"), F.col("spine")) & (F.trim(F.coalesce("text", F.lit(""))) != "")).withColumn("__n", F.length("text"))
    own = grouped(kept, work, pos, "__n", short)
    name = F.coalesce(F.nullif("label", F.lit("")), "spine", F.lit(""))
    whole = own.groupBy(work, "chapter").agg(F.max_by(name, F.struct(F.col("__n"), (-F.col(pos)).alias("p"))).alias("label"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("pos"), "text"))), lambda x: x["text"]), "\n\n").alias("text"))

    @F.pandas_udf("array<string>")
    def parts(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: cut(t, most))

    each = whole.select(work, "chapter", "label", F.posexplode(parts("text")).alias("part", "text"))
    index = F.row_number().over(Window.partitionBy(work).orderBy("chapter", "part"))
    label = F.when(F.col("part") > 0, F.concat("label", F.lit(" (part "), (F.col("part") + 1).cast("string"), F.lit(")"))).otherwise(F.col("label"))
    return each.select(work, index.alias("index"), label.alias("label"), "text")


#: A line that heads a chapter: the word and a number in digits, Roman digits or words, a title after it or not; or a prologue and the like.
HEADING = r"^[ \t]*(?:chapter|part|book)[ \t]+(?:[0-9]+|[ivxlcdm]+|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen|eighteen|nineteen|twenty)\b[^\n]{0,80}$|^[ \t]*(?:prologue|epilogue|interlude|introduction)[ \t]*$"


def prose_units(text: str, most: int = 8000) -> list[tuple[str, str]]:
    """Label and text of what stands under each heading of a plain text; without headings, pieces of most signs."""
    heads = list(re.finditer(HEADING, text, re.I | re.M))
    if not heads:
        return [(f"Part {i + 1}", p) for i, p in enumerate(cut(text, most))] if text.strip() else []
    out = [("Opening", text[: heads[0].start()])] if text[: heads[0].start()].strip() else []
    for a, b in zip(heads, [*heads[1:], None], strict=True):
        out.append((a[0].strip(), text[a.end() : b.start() if b else len(text)].strip("\n")))
    return [(n, t) for n, t in out if t.strip()]


def prose_chapters(works: DataFrame, work: str, most: int = 8000) -> DataFrame:
    """work, index, label, text of plain texts (work, text), a row a chapter; null and blank texts have none."""

    @F.pandas_udf("array<struct<label: string, text: string>>")
    def units(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"label": n, "text": p} for n, p in prose_units(t or "", most)])

    return works.select(work, F.posexplode(units("text")).alias("pos", "u")).select(work, (F.col("pos") + 1).alias("index"), "u.label", "u.text")
