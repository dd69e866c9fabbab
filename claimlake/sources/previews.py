"""Preview artefacts, one JSON object for each document and run, and the candidates that their import yields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names, scores

_CLAIM = "struct<`from`: string, `to`: string, type: string, chapter: string, validation_p: variant, validation_state: string, validation_note: string, claimed_type: string>"
_PERSON = "struct<name: string, aliases: array<string>, evidence: string, unresolved_mentions: variant>"
SCHEMA = f"work_id string, title string, author string, characters array<{_PERSON}>, minor_characters array<{_PERSON}>, relationships array<{_CLAIM}>, minor_sourced_relationships array<{_CLAIM}>, dropped_relationships array<{_CLAIM}>, possible_merges array<struct<name_a: string, name_b: string, p_yes: variant, reason: string>>"
CLAIM_LISTS = ("relationships", "minor_sourced_relationships", "dropped_relationships")
PEOPLE = ("characters", "minor_characters")
CLAIM_KEY = ["work_id", "from", "to", "type", "chapter"]


def scan(spark: SparkSession, path: str) -> DataFrame:
    """Artefacts under a folder, a whole file each; a byte-order mark is no part of the JSON."""
    files = spark.read.text(path, wholetext=True)
    return parsed(files.select(F.regexp_replace("value", "^\\ufeff", "").alias("value"), F.col("_metadata.file_name").alias("file")))


def parsed(texts: DataFrame) -> DataFrame:
    """The fields of artefacts (value, file): objects only, work_id where missing from title and author, or the file's name for the title.

    A text that is no JSON object is an error that names its file, as nothing of it may be imported by halves.
    """
    good = F.coalesce(F.expr("schema_of_variant(try_parse_json(value)) LIKE 'OBJECT%'"), F.lit(False))
    checked = texts.select("file", F.when(good, F.from_json("value", SCHEMA)).otherwise(F.raise_error(F.concat(F.lit("not a JSON object: "), F.coalesce("file", F.lit("?"))))).alias("o")).select("file", "o.*")
    stem = F.regexp_replace("file", r"\.[^.]*$", "")
    own = F.concat(F.lit("title:"), names.tidy_title(F.coalesce(F.nullif("title", F.lit("")), stem)), F.lit("|"), names.tidy_title("author"))
    return checked.withColumn("work_id", F.coalesce(F.nullif("work_id", F.lit("")), own))


def people(art: DataFrame) -> DataFrame:
    """work_id, name, list, pos, evidence, mentions: principals before minors, the first entry of a name wins. An artefact with neither list is an error that names its work."""
    lost = F.raise_error(F.concat(F.lit("no list of characters: "), "work_id"))
    art = art.withColumn(PEOPLE[0], F.when(F.col(PEOPLE[0]).isNull() & F.col(PEOPLE[1]).isNull(), lost).otherwise(F.col(PEOPLE[0])))
    each = art.select("work_id", F.explode(_listed(PEOPLE)).alias("e")).select("work_id", "e.list", "e.pos", F.col("e.x").alias("p"))
    rows = each.filter("p.name <> ''").select("work_id", F.col("p.name").alias("name"), "list", "pos", F.col("p.evidence").alias("evidence"), F.col("p.unresolved_mentions").alias("mentions"))
    first = rows.groupBy("work_id", "name").agg(F.min(F.struct("list", "pos")).alias("first")).select("work_id", "name", "first.list", "first.pos")
    return rows.join(first, ["work_id", "name", "list", "pos"])


def claims(art: DataFrame) -> DataFrame:
    """work_id, list, pos and the fields of every claim of the three lists; score: the recorded number, or null."""
    rows = art.select("work_id", F.explode(_listed(CLAIM_LISTS)).alias("e")).filter("e.x IS NOT NULL").select("work_id", "e.list", "e.pos", "e.x.*")
    return _scored(rows)


def _listed(lists: tuple[str, ...]) -> Column:
    """The entries (list, pos, x) of several lists as one array, so that an artefact is read once for all of them; a null list has none. To explode a bare list would read an artefact again for the filter that Spark infers from it."""

    def numbered(c: str, n: int) -> Column:
        return F.transform(c, lambda x, i: F.struct(F.lit(n).alias("list"), i.alias("pos"), x.alias("x")))

    each = [numbered(c, n) for n, c in enumerate(lists)]
    return F.flatten(F.filter(F.array(*each), lambda a: a.isNotNull()))


def _scored(rows: DataFrame) -> DataFrame:
    return rows.withColumn("score", scores.recorded(F.col("validation_p"))).withColumn("judged", F.col("validation_p").isNotNull() & ~F.expr("coalesce(is_variant_null(validation_p), true)"))


def stored_names(art: DataFrame) -> DataFrame:
    """work_id, name: principals, and the sources of shipped claims that were validated or reviewed with a score."""
    return _with_people(art).filter(_NAMES_STORED).select("work_id", F.col("from").alias("name")).distinct()


def _with_people(art: DataFrame) -> DataFrame:
    """claims() and, as rows of list -1 that have a source alone, the principals: an artefact's rows in one pass."""
    no_claim = F.lit(None).cast(_CLAIM)
    people_ = F.transform("characters", lambda p, i: F.struct(F.lit(-1).alias("list"), i.alias("pos"), no_claim.alias("x"), p["name"].alias("name")))
    claims_ = F.transform(F.filter(_listed(CLAIM_LISTS), lambda e: e["x"].isNotNull()), lambda e: F.struct(e["list"].alias("list"), e["pos"].alias("pos"), e["x"].alias("x"), e["x"]["from"].alias("name")))
    both = F.flatten(F.filter(F.array(people_, claims_), lambda a: a.isNotNull()))
    rows = art.select("work_id", F.explode(both).alias("e")).select("work_id", "e.list", "e.pos", "e.x.*", F.col("e.name").alias("__name"))
    return _scored(rows).withColumn("from", F.col("__name")).drop("__name")


#: Of the rows of _with_people, those whose source is stored by them: principals, and shipped claims that earned it.
_NAMES_STORED = "`from` <> '' AND (list = -1 OR list < 2 AND (validation_state = 'validated' OR validation_state = 'review_required' AND judged))"


def _known(art: DataFrame) -> DataFrame:
    """claims() with stored: whether their source is among stored_names. A source's rows come together once, and identities are told from there without another shuffle."""
    rows = _with_people(art).drop("validation_p").withColumn("__earned", F.coalesce(F.expr(_NAMES_STORED) & F.col("work_id").isNotNull(), F.lit(False)))
    return rows.withColumn("stored", F.max("__earned").over(Window.partitionBy("work_id", "from"))).filter("list >= 0").drop("__earned")


def _dropped() -> Column:
    """Of claims(), those that never shipped."""
    return (F.col("list") == 2) | F.col("validation_state").eqNullSafe("rejected")


def _first(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in keys]), F.struct("list", "pos")).alias("__r")).select(*keys, "__r.*")


def dropped_claims(art: DataFrame) -> DataFrame:
    """Claims that never shipped, the first of each identity: the dropped list and rejected ones of the others; state: note, state or dropped."""
    return _first(claims(art).filter(_dropped()), CLAIM_KEY).withColumn("state", _said("dropped"))


def near_misses(art: DataFrame) -> DataFrame:
    """Judged claims of stored sources that shipped without confirming, unless dropped_claims has them."""
    missed = (F.col("list") < 2) & F.col("judged") & F.col("stored") & ~scores.shipped_confirmed(F.col("validation_state"), F.col("validation_note"), F.col("type"))
    rows = _known(art)
    kept = [c for c in rows.columns if c not in (*CLAIM_KEY, "stored")]
    first = F.min_by(F.struct(*kept), F.when(missed, F.struct("list", "pos")))
    each = rows.filter(missed | _dropped()).groupBy(*CLAIM_KEY).agg(F.bool_or(_dropped()).alias("__d"), first.alias("__r")).filter("NOT __d")
    return each.select(*CLAIM_KEY, "__r.*").withColumn("state", _said("unconfirmed"))


def _said(otherwise: str):
    return F.coalesce(F.nullif("validation_note", F.lit("")), F.nullif("validation_state", F.lit("")), F.lit(otherwise))


def merges(art: DataFrame) -> DataFrame:
    """Pairs left for review, the first of each unordered pair; a pair that lacks a name stays as recorded."""
    rows = art.select("work_id", F.explode(_listed(("possible_merges",))).alias("e")).filter("e.x IS NOT NULL").select("work_id", "e.list", "e.pos", "e.x.*")
    whole = F.coalesce((F.col("name_a") != "") & (F.col("name_b") != ""), F.lit(False))
    key = F.when(whole, names.pair_key(F.col("name_a"), F.col("name_b"))).otherwise(F.concat(F.lit("#"), F.col("pos").cast("string")))
    return _first(rows.withColumn("pair", key), ["work_id", "pair"]).withColumn("state", F.coalesce(F.nullif("reason", F.lit("")), F.lit("left_for_review"))).withColumn("score", scores.recorded(F.col("p_yes")))


def mentions(art: DataFrame) -> DataFrame:
    """work_id, character, mention, evidence: each mention of a person once; a bare string is one mention, and a shape that is neither text nor a list of texts is an error that names the person."""
    many, one = F.expr("try_variant_get(mentions, '$', 'array<string>')"), F.expr("try_variant_get(mentions, '$', 'string')")
    kind = F.expr("schema_of_variant(mentions)")
    bad = F.raise_error(F.concat(F.lit("mentions of no known shape: "), "work_id", F.lit(", "), "name"))
    none = F.col("mentions").isNull() | F.coalesce(F.expr("is_variant_null(mentions)"), F.lit(True))
    said = F.when(none, F.array().cast("array<string>")).when((kind == "ARRAY<STRING>") | (kind == "ARRAY<VOID>"), many).when(kind == "STRING", F.array(one)).otherwise(bad)
    return people(art).select("work_id", F.col("name").alias("character"), "evidence", F.explode(said).alias("mention")).dropDuplicates(["work_id", "character", "mention"])


def alerts(art: DataFrame, floor: float = 0.30) -> DataFrame:
    """work_id, kind, label, type, score, reason: scored candidates at or over the floor, merges only under scores.MERGE_AT; each identity once, candidates before claims of people outside the store.

    One pass over the claims: each is marked as dropped, near miss or claim of an unstored person, and an identity's
    firsts of each kind come from one aggregation.
    """
    shown = scores.claim_label(F.col("from"), F.col("to"))
    rows, dropped = _known(art), _dropped()
    open_ = (F.col("list") < 2) & ~scores.shipped_confirmed(F.col("validation_state"), F.col("validation_note"), F.col("type"))
    stored = F.col("stored")
    at, high = F.struct("list", "pos"), F.coalesce(F.col("score") >= floor, F.lit(False))

    def first(otherwise: str, when):
        return F.min_by(F.struct("score", _said(otherwise).alias("state")), F.when(when, at))

    each = rows.groupBy(*CLAIM_KEY).agg(F.bool_or(dropped).alias("was_dropped"), first("dropped", dropped).alias("d"), first("unconfirmed", open_ & stored & F.col("judged")).alias("n"), first("unconfirmed", open_ & ~stored & (F.col("from") != "") & high).alias("r"))
    found = F.when(F.col("was_dropped"), F.col("d")).otherwise(F.col("n"))
    r = F.when(F.coalesce(found["score"] >= floor, F.lit(False)), found).otherwise(F.col("r"))
    said = each.withColumn("r", r).filter("r IS NOT NULL").select("work_id", F.lit("claim").alias("kind"), shown.alias("label"), "type", "r.score", F.col("r.state").alias("reason"))
    band = merges(art).filter((F.col("score") >= floor) & (F.col("score") < scores.MERGE_AT))
    a, b = (F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("(unnamed)")) for c in ("name_a", "name_b"))
    pairs = band.select("work_id", F.lit("merge").alias("kind"), F.concat(F.least(a, b), F.lit(" ↔ "), F.greatest(a, b)).alias("label"), F.lit("merge").alias("type"), "score", F.col("state").alias("reason"))
    return said.union(pairs)
