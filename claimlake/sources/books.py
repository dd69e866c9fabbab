"""Books as files: chapters of EPUB archives and plain texts, files not seen before, and dated datasets.

A book is read by one task, whole, within stated limits of size; books spread over tasks as files do.
"""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import unquote
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tags that begin and end a line, and tags whose text nobody reads.
BLOCKS = ("p", "div", "br", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "blockquote", "section", "article")
UNSEEN = ("script", "style", "title")
#: Characters under which a document of the spine is no chapter; bytes of one entry and of a book once unpacked.
MIN_CHARS, ENTRY_BYTES, BOOK_BYTES = 800, 16 << 20, 256 << 20
CHAPTERS = "path string, chapter int, text string, failed string"


class _Page(HTMLParser):
    """The lines of a page as its tags come by; what stands inside an unseen tag is passed over."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines, self.open = [""], []

    def _edge(self, tag: str) -> None:
        if tag in BLOCKS:
            self.lines.append("")

    def handle_starttag(self, tag, attrs):
        self.open.append(tag) if tag in UNSEEN else self._edge(tag)

    def handle_startendtag(self, tag, attrs):
        self._edge(tag)

    def handle_endtag(self, tag):
        if tag in UNSEEN:
            del self.open[-1:]
        else:
            self._edge(tag)

    def handle_data(self, data):
        if not self.open:
            first, *more = data.split("\n")
            self.lines[-1] += first
            self.lines += more


def lines_of(page: str | None) -> str:
    """The text that a reader of a page sees, a line for each block; lines are stripped and empty ones dropped."""
    reader = _Page()
    reader.feed(page or "")
    reader.close()
    return "\n".join(x for x in map(str.strip, reader.lines) if x)


def _named(tree: ElementTree.Element, tag: str) -> list[ElementTree.Element]:
    return [e for e in tree.iter() if e.tag.rpartition("}")[2] == tag]


def spine_texts(content: bytes, min_chars: int, entry_bytes: int, book_bytes: int) -> list[str]:
    """Texts of the spine in reading order. A limit that is passed is an error; a part that is missing or no text is left out."""
    left = book_bytes
    with zipfile.ZipFile(io.BytesIO(content)) as book:

        def entry(name: str) -> bytes:
            nonlocal left
            with book.open(name) as f:  # the stated size may lie, so the bytes are counted as they come
                data = f.read(min(entry_bytes, left) + 1)
            if len(data) > min(entry_bytes, left):
                raise ValueError(f"over the limit: {name}")
            left -= len(data)
            return data

        package = _named(ElementTree.fromstring(entry("META-INF/container.xml")), "rootfile")[0].attrib["full-path"]
        opf = ElementTree.fromstring(entry(package))
        files = {e.get("id"): posixpath.normpath(posixpath.join(posixpath.dirname(package), unquote(e.get("href", "")))) for e in _named(opf, "item")}
        texts = []
        for ref in _named(opf, "itemref"):
            name = files.get(ref.get("idref"))
            if ref.get("linear") == "no" or name not in book.NameToInfo:
                continue
            data = entry(name)
            try:
                text = lines_of(data.decode("utf-8-sig"))
            except UnicodeDecodeError:
                continue
            if len(text) >= min_chars:
                texts.append(text)
    return texts


def epub_chapters(files: DataFrame, min_chars: int = MIN_CHARS, entry_bytes: int = ENTRY_BYTES, book_bytes: int = BOOK_BYTES) -> DataFrame:
    """path, chapter (from 1, kept ones only), text, failed for each chapter of archives in `files` (path, content).

    A book that is no archive, lacks a part it names as its root, or passes a limit gives one row with the reason in
    `failed` and no text, so that it neither stops the job nor passes for an empty book. Null contents fail likewise.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    texts = spine_texts(content or b"", min_chars, entry_bytes, book_bytes)
                    rows = [(path, i, text, None) for i, text in enumerate(texts, 1)]
                except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, IndexError, ValueError, RuntimeError, NotImplementedError, EOFError) as e:
                    rows = [(path, None, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(rows, columns=["path", "chapter", "text", "failed"]).astype({"chapter": "Int32"})

    return files.select("path", "content").mapInPandas(read, CHAPTERS)


def scan_epubs(spark: SparkSession, path: str, **limits: int) -> DataFrame:
    return epub_chapters(spark.read.format("binaryFile").option("pathGlobFilter", "*.epub").load(path), **limits)


def scan_texts(spark: SparkSession, path: str) -> DataFrame:
    """path, chapter, text: each file under path is one chapter."""
    texts = spark.read.option("pathGlobFilter", "*.txt").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return texts.select("path", F.lit(1).alias("chapter"), "text")


def unseen(files: DataFrame, known: DataFrame) -> DataFrame:
    """Files (path, content) with `sha256`, one for each content that `known` (sha256) lacks: the least path stays.

    Contents do not move: hashes alone are reduced and joined back by path. Null contents are never taken.
    """
    hashed = files.filter("content IS NOT NULL").withColumn("sha256", F.sha2("content", 256))
    keep = hashed.groupBy("sha256").agg(F.min("path").alias("path")).join(known.select("sha256").distinct(), "sha256", "left_anti")
    return hashed.join(keep, ["path", "sha256"], "left_semi")


def write_dataset(df: DataFrame, folder: str, name: str, day: str) -> DataFrame:
    """Writes df as JSON lines to folder/name/day=<day> (a rerun of a day replaces it) and returns its line of the manifest.

    The manifest is a row for each write under folder/manifest, with name, day and rows, appended once the data are there.
    """
    spark, path = df.sparkSession, f"{folder}/{name}/day={day}"
    df.write.mode("overwrite").json(path)
    line = spark.read.text(path).agg(F.lit(name).alias("name"), F.lit(day).alias("day"), F.count(F.lit(1)).alias("rows"))
    line.write.mode("append").json(f"{folder}/manifest")
    return line
