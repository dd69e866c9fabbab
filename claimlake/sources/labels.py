"""Label files and seat files: what people ruled, from JSON pair lists and from Markdown lines. Malformed labels are errors that name their place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names

_ENTRY = "struct<name_a: string, name_b: string, label: string, book: string, desc_a: string, desc_b: string, evidence_a: string, evidence_b: string, source: string, scored: variant, stub_score: double>"
_LEGACY = "struct<a: string, b: string, same_person: boolean, uncertain: variant, book: string, source: string>"


def scan(spark: SparkSession, path: str) -> DataFrame:
    """file, value: files under a folder, a whole file each."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")


def _or(c: Column, otherwise: str) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(otherwise))


def _bad(file: Column, at: Column, what: str) -> Column:
    return F.raise_error(F.concat(file, F.lit(", entry "), at.cast("string"), F.lit(": " + what)))


def pairs(files: DataFrame) -> DataFrame:
    """file, at, name_a, name_b, expected, book, desc_a, desc_b, evidence_a, evidence_b, source, scored, stub_score of every labelled pair of JSON label files (file, value).

    A file is a list of pairs (name_a, name_b, label same or different, scored unless it says false) or a map of older
    entries (a, b, same_person), of which uncertain ones are passed over. Anything else is an error: a file of another
    shape, an entry that is no object, one without names or a known label. at: the place in the list or the key.
    """
    v = F.expr("try_parse_json(value)")
    kind = F.expr("schema_of_variant(try_parse_json(value))")
    known = F.coalesce(kind.rlike("^(ARRAY|OBJECT)"), F.lit(False))
    lost = F.raise_error(F.concat("file", F.lit(": no list of pairs and no map of labels"))).cast("string")
    x = files.select("file", v.alias("v"), F.when(known, kind).otherwise(lost).alias("kind"))
    listed = x.filter("kind LIKE 'ARRAY%'").select("file", F.posexplode(F.expr("variant_get(v, '$', 'array<variant>')")).alias("at", "e"))
    e = F.expr(f"try_variant_get(e, '$', '{_ENTRY}')")
    object_ = F.coalesce(F.expr("schema_of_variant(e)").startswith("OBJECT"), F.lit(False))
    listed = listed.select("file", F.col("at").cast("string").alias("at"), F.when(object_, e).otherwise(_bad(F.col("file"), F.col("at"), "no object")).alias("p"))
    p = F.col("p")
    named = (F.coalesce(p["name_a"], F.lit("")) != "") & (F.coalesce(p["name_b"], F.lit("")) != "")
    label = F.when(~named, _bad(F.col("file"), F.col("at"), "needs name_a and name_b").cast("boolean")).when(p["label"] == "same", True).when(p["label"] == "different", False).otherwise(_bad(F.col("file"), F.col("at"), "label must be same or different").cast("boolean"))
    scored = ~F.coalesce(F.expr("try_variant_get(p.scored, '$', 'boolean')") == F.lit(False), F.lit(False))
    new = listed.select("file", "at", p["name_a"].alias("name_a"), p["name_b"].alias("name_b"), label.alias("expected"), _or(p["book"], "unknown").alias("book"), *(_or(p[c], "").alias(c) for c in ("desc_a", "desc_b", "evidence_a", "evidence_b", "source")), scored.alias("scored"), p["stub_score"].alias("stub_score"))
    old = x.filter("kind LIKE 'OBJECT%'").select("file", F.explode(F.expr("variant_get(v, '$', 'map<string, variant>')")).alias("at", "e"))
    old = old.filter(F.coalesce(F.expr("schema_of_variant(e)").startswith("OBJECT"), F.lit(False))).select("file", "at", F.expr(f"try_variant_get(e, '$', '{_LEGACY}')").alias("p"))
    old = old.filter(~F.coalesce(F.expr("try_variant_get(p.uncertain, '$', 'boolean')"), F.lit(False)))
    whole = p["a"].isNotNull() & p["b"].isNotNull() & p["same_person"].isNotNull()
    said = F.when(whole, p["same_person"]).otherwise(_bad(F.col("file"), F.col("at"), "needs a, b and same_person").cast("boolean"))
    old = old.select("file", "at", p["a"].alias("name_a"), p["b"].alias("name_b"), said.alias("expected"), _or(p["book"], "unknown").alias("book"), *(F.lit("").alias(c) for c in ("desc_a", "desc_b", "evidence_a", "evidence_b")), _or(p["source"], "").alias("source"), F.lit(True).alias("scored"), F.lit(None).cast("double").alias("stub_score"))
    return new.unionByName(old)


def labels_for(works: DataFrame, fixtures: DataFrame) -> DataFrame:
    """works (work_id, title, author) with file: the first of the fixtures (file, work_id, book), in order of their names, that bears the work's id, or whose book holds both title and author as names.norm() gives them; null without one."""
    title, author = names.norm("title"), names.norm("author")
    f = fixtures.select("file", F.col("work_id").alias("__id"), names.norm("book").alias("__book"))
    # fixtures are files that people wrote by hand: a few for a library
    by_id = works.join(f.filter("__id <> ''"), F.col("work_id") == F.col("__id"))
    by_book = works.filter((title != "") & (author != "")).join(F.broadcast(f.filter("__book <> ''").limit(100_000)), F.contains("__book", title) & F.contains("__book", author))
    first = by_id.select("work_id", "file").union(by_book.select("work_id", "file")).groupBy(F.col("work_id").alias("__w")).agg(F.min("file").alias("file"))
    return works.join(first, F.col("work_id") == F.col("__w"), "left").drop("__w")


#: The grammars of a seat file's lines, the first that fits counts.
UUID = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
VERDICTS = "CONFIRM|REJECT|ABSTAIN"
TABLE = rf"^\|\s*({UUID})\s*\|\s*(.+?)\s*\|\s*(.+?)\s*\|\s*[0-9.]+\s*\|\s*({VERDICTS})\s*\|"
ID_LIST = rf"^-\s*({UUID})\s+—\s+(.+?)\s+—\s+(.+?)\s+—\s*[0-9.]+\s+—\s*({VERDICTS})\b"
ESCALATION = rf"^-\s*(.+?)\s+—\s+(.+?)\s+\(claim\s+({UUID})\)"
CANDIDATE = rf"^(?:-\s*)?(.+?)\s+—\s+(.+?):\s+({VERDICTS})\b\s*(?:—\s*(.*))?$"


def seat_lines(files: DataFrame) -> DataFrame:
    """file, line, kind, claim, book, trope, verdict, rationale, date of every line of Markdown seat files (file, value) that says something.

    kind: verdict, link (a claim's id without a verdict), or unresolved: a line that names a verdict after a colon and
    reads like one, but fits no grammar. date: the first ten signs of the file's name. Lines count from 1.
    """
    x = files.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("line", "raw")).select("file", (F.col("line") + 1).alias("line"), F.trim(F.regexp_replace("raw", r"^\s+|\s+$", "")).alias("s")).filter("s <> ''")
    s = F.col("s")

    def got(pattern: str, i: int) -> Column:
        return F.regexp_extract(s, pattern, i)

    none = F.lit(None).cast("string")

    def row(kind: str, claim, book, trope, verdict, rationale) -> Column:
        return F.struct(F.lit(kind).alias("kind"), claim.alias("claim"), book.alias("book"), trope.alias("trope"), verdict.alias("verdict"), rationale.alias("rationale"))

    stray = s.rlike(rf":\s*({VERDICTS})\b") & F.contains(s, F.lit("—")) & ~s.startswith("#")
    segment = F.substring_index(F.regexp_extract(s, rf"^(.*?):\s*(?:{VERDICTS})\b", 1), "—", -1)
    parsed = (
        F.when(s.rlike(TABLE), row("verdict", got(TABLE, 1), got(TABLE, 2), got(TABLE, 3), got(TABLE, 4), F.lit("")))
        .when(s.rlike(ID_LIST), row("verdict", got(ID_LIST, 1), got(ID_LIST, 2), got(ID_LIST, 3), got(ID_LIST, 4), F.lit("")))
        .when(s.rlike(ESCALATION), row("link", got(ESCALATION, 3), got(ESCALATION, 1), got(ESCALATION, 2), none, none))
        .when(s.rlike(CANDIDATE), row("verdict", none, got(CANDIDATE, 1), got(CANDIDATE, 2), got(CANDIDATE, 3), F.trim(got(CANDIDATE, 4))))
        .when(stray & (F.length(segment) <= 70) & ~F.contains(segment, F.lit(".")), row("unresolved", none, none, none, none, F.left(s, F.lit(100))))
    )
    return x.withColumn("r", parsed).filter("r IS NOT NULL").select("file", "line", "r.*", F.left("file", F.lit(10)).alias("date"))


def seat_verdicts(lines: DataFrame) -> DataFrame:
    """Verdict lines with the claim that they are about: their own, or the one that the file links to the same book and trope (as names.fixture_key() gives them), the last link of a file counting."""
    linked = lines.filter("claim IS NOT NULL AND kind <> 'unresolved'").groupBy(F.col("file").alias("__f"), names.fixture_key("book").alias("__b"), names.fixture_key("trope").alias("__t")).agg(F.max_by("claim", "line").alias("__claim"))
    said = lines.filter("kind = 'verdict'")
    on = (F.col("file") == F.col("__f")) & (names.fixture_key("book") == F.col("__b")) & (names.fixture_key("trope") == F.col("__t"))
    return said.join(linked, on, "left").withColumn("claim", F.coalesce("claim", "__claim")).drop("__f", "__b", "__t", "__claim")
