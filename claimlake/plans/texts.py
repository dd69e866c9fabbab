"""Quotes, slips, mentions and kinship over documents. Each query has DuckDB SQL for the same rows where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import evidence as sentences_of
from ..functions import names
from ..operators import evidence
from .queries import query, unchecked

_LOW, _HIGH = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_W = r"[\p{L}\p{M}\p{N}]+(?:[''’][\p{L}\p{M}\p{N}]+)*"
_SENTENCES = r"""s AS (SELECT doc_id, source, text, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])[ \t\n\r\f\v]+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), lambda x: x <> '') AS pieces FROM documents WHERE text IS NOT NULL)"""


def _candidates(t):
    """A quote of each document: its third sentence, upper-cased in every other document, without its commas."""
    d = t("documents").filter("text IS NOT NULL")
    third = sentences_of.sentence("text", 2)
    quote = F.translate(F.when(F.col("doc_id") % 2 == 0, F.translate(third, _LOW, _HIGH)).otherwise(third), ",", "")
    return d.select(F.col("doc_id").alias("id"), "source", quote.alias("quote"), F.when(F.col("doc_id") % 3 == 0, "signature").otherwise("evidence").alias("kind"), F.when(F.col("doc_id") % 5 != 0, F.col("doc_id")).alias("asserted"))


@query(rf"""WITH {_SENTENCES}, c AS (SELECT doc_id AS id, source, replace(CASE WHEN doc_id % 2 = 0 THEN translate(pieces[3], '{_LOW}', '{_HIGH}') ELSE pieces[3] END, ',', '') AS quote, CASE WHEN doc_id % 3 = 0 THEN 'signature' ELSE 'evidence' END AS kind, CASE WHEN doc_id % 5 <> 0 THEN doc_id END AS asserted FROM s),
w AS (SELECT *, list_transform(regexp_extract_all(quote, '{_W}'), lambda x: replace(lower(x), '’', '''')) AS words FROM c), n AS (SELECT *, ' ' || array_to_string(words, '  ') || ' ' AS needle FROM w WHERE len(words) > 0),
h AS (SELECT doc_id, source, ' ' || array_to_string(list_transform(regexp_extract_all(text, '{_W}'), lambda x: replace(lower(x), '’', '''')), '  ') || ' ' AS hay FROM documents WHERE text IS NOT NULL),
m AS (SELECT n.id, n.kind, n.asserted, h.doc_id, (length(hay) - length(replace(hay, needle, ''))) // length(needle) AS times FROM n JOIN h ON n.source = h.source AND contains(hay, needle)),
i AS (SELECT *, asserted IS NULL OR kind = 'signature' OR doc_id = asserted AS inside FROM m)
SELECT c.id, count(*) FILTER (inside) > 0 AS verified, CASE WHEN count(*) FILTER (inside) = 0 THEN CASE WHEN count(i.id) > 0 THEN 'chapter' ELSE 'words' END END AS reason, min(doc_id) AS found_chapter, min(doc_id) FILTER (inside) AS chapter, CAST(sum(times) FILTER (inside) AS BIGINT) AS occurrences FROM c LEFT JOIN i ON c.id = i.id GROUP BY 1""")
def quotes_verified(t):
    d = t("documents").filter("text IS NOT NULL").select("source", F.col("doc_id").alias("chapter"), "text")
    return evidence.verified_quotes(_candidates(t), d, "source", "chapter").select("id", "verified", "reason", "found_chapter", "chapter", "occurrences")


@unchecked
def evidence_slips(t):
    """Each document's second sentence with a few signs lost, checked against the document."""
    d = t("documents").filter("text IS NOT NULL").withColumn("quote", sentences_of.sentence("text", 1))
    at = F.col("doc_id") % 7 + 3
    torn = F.when(F.col("doc_id") % 3 == 0, F.concat(F.left("quote", at.cast("int")), F.substring("quote", at.cast("int") + 3, F.length("quote")))).otherwise(F.when(F.col("doc_id") % 3 == 1, F.reverse("quote")).otherwise(F.col("quote")))
    return evidence.checked_evidence(d.withColumn("quote", torn), "quote", "text").select("doc_id", "evidence", "distance")


@query(r"""WITH n AS (SELECT DISTINCT lower(split_part(text, ' ', 1)) AS name FROM benchmark WHERE regexp_full_match(split_part(text, ' ', 1), '[A-Za-z]+')), w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+')) AS name FROM documents)
SELECT doc_id, name, count(*) AS n FROM w JOIN n USING (name) GROUP BY 1, 2""")
def name_mentions(t):
    """Mentions of the benchmark items' first words, as the names of one work."""
    first = F.lower(F.substring_index("text", " ", 1))
    people = t("benchmark").select(F.lit("all").alias("work"), first.alias("name")).filter("name RLIKE '^[A-Za-z]+$'").distinct()
    texts = t("documents").select(F.lit("all").alias("work"), "doc_id", "text")
    return evidence.mentions(texts, people, "work", ["doc_id"]).groupBy("doc_id", "name").agg(F.count(F.lit(1)).alias("n"))


@query(r"""WITH e AS (SELECT event_id, user_id, event_type, CAST(floor(value) AS INT) AS a, CAST(floor(value) AS INT) + event_id % 9 AS b, CAST(day(ts) AS INT) AS sentence, CAST(event_id % 3 AS INT) AS rank FROM events),
p AS (SELECT x.user_id, x.sentence, x.event_type AS a, y.event_type AS b, x.rank AS ar, x.a AS as_, x.b AS ae, y.rank AS br, y.a AS bs, y.b AS be FROM e x JOIN e y ON x.user_id = y.user_id AND x.sentence = y.sentence AND x.event_type < y.event_type AND (x.b <= y.a OR y.b <= x.a)),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, sentence, a, b ORDER BY ar, br, as_, bs, ae, be) AS k FROM p)
SELECT user_id, sentence, a, b, ar AS a_form_rank, as_ AS a_start, ae AS a_end, br AS b_form_rank, bs AS b_start, be AS b_end FROM r WHERE k = 1""")
def pair_placements(t):
    """Forms of persons in sentences, as events stand for them: a user's day is a sentence."""
    start = F.floor("value").cast("int")
    found = t("events").select("user_id", F.dayofmonth("ts").alias("sentence"), F.col("event_type").alias("person"), (F.col("event_id") % 3).cast("int").alias("form_rank"), start.alias("start"), (start + (F.col("event_id") % 9).cast("int")).alias("end"))
    kinds = t("events").agg(F.sort_array(F.collect_set("event_type")).alias("all"))  # a handful
    pairs = kinds.select("all", F.explode("all").alias("a")).select("a", F.explode("all").alias("b")).filter("a < b")
    return evidence.placed_pairs(found, pairs, ["user_id", "sentence"])


@query("""SELECT p_partkey, CASE WHEN strpos(p_name, ',') > 0 THEN regexp_replace(lower(split_part(trim(p_name), ',', 1)), '[^a-z0-9]', '', 'g') ELSE regexp_replace(lower(list_extract(string_split_regex(trim(p_name), '\\s+'), -1)), '[^a-z0-9]', '', 'g') END AS surname,
CASE WHEN lower(a) = lower(b) THEN NULL WHEN lower(a) > lower(b) THEN b || '>' || a || ':' || CASE kind WHEN 'parent' THEN 'child' WHEN 'child' THEN 'parent' ELSE kind END ELSE a || '>' || b || ':' || kind END AS pair,
CASE WHEN list_has_any(string_split_regex(lower(p_name), '\\s+'), string_split_regex(lower(p_type), '\\s+')) THEN CAST(0.9 AS DOUBLE) ELSE CAST(0.1 AS DOUBLE) END AS overlap,
CASE WHEN split_part(p_name, ' ', 1) = p_name THEN 'full' WHEN f = p_name THEN 'full' WHEN f = split_part(p_name, ' ', 1) THEN 'first' WHEN f = list_extract(string_split(p_name, ' '), -1) THEN 'surname' ELSE 'nickname' END AS form, p_brand || CASE WHEN p_size % 2 = 0 THEN ' #' || (p_size // 2) ELSE ' #' || (p_size / 2.0) END AS series
FROM (SELECT *, p_brand AS a, p_type AS b, CASE p_size % 3 WHEN 0 THEN 'parent' WHEN 1 THEN 'child' ELSE 'ally' END AS kind, CASE p_partkey % 3 WHEN 0 THEN split_part(p_name, ' ', 1) WHEN 1 THEN list_extract(string_split(p_name, ' '), -1) ELSE 'Bo' END AS f FROM part)""".replace("\\\\", "\\"))
def name_forms(t):
    p = t("part")
    kind = F.when(F.col("p_size") % 3 == 0, "parent").when(F.col("p_size") % 3 == 1, "child").otherwise("ally")
    form = F.when(F.col("p_partkey") % 3 == 0, F.substring_index("p_name", " ", 1)).when(F.col("p_partkey") % 3 == 1, F.substring_index("p_name", " ", -1)).otherwise("Bo")
    pair = names.canonical_pair(F.col("p_brand"), F.col("p_type"), kind)
    return p.select("p_partkey", names.surname("p_name").alias("surname"), F.concat(pair["source"], F.lit(">"), pair["target"], F.lit(":"), pair["kind"]).alias("pair"), names.overlap_score(F.col("p_name"), F.col("p_type")).alias("overlap"), names.form_class(form, F.col("p_name")).alias("form"), names.series_label(F.col("p_brand"), F.col("p_size") / 2).alias("series"))


@query("SELECT event_type, count(*) FILTER (event_id % 3 <> 2) AS read, CAST(coalesce(sum(CAST(json_extract(props, '$.k') AS BIGINT)) FILTER (event_id % 3 <> 2), 0) AS BIGINT) AS sum_k FROM events WHERE json_valid(props) GROUP BY 1")
def salvaged_payloads(t):
    """Payloads as a model wrote them: bare, with words around them, or cut off."""
    n = F.col("event_id")
    written = F.when(n % 3 == 0, F.col("props")).when(n % 3 == 1, F.concat(F.lit("Here it is: "), "props", F.lit(" Anything else?"))).otherwise(F.concat(F.lit("{"), F.left("props", F.lit(3))))
    k = sentences_of.salvaged(written, "k long")["k"]
    return t("events").filter(F.expr("try_parse_json(props) IS NOT NULL")).groupBy("event_type").agg(F.count(k).alias("read"), F.coalesce(F.sum(k), F.lit(0)).alias("sum_k"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_name END AS series, CASE p_partkey % 3 WHEN 0 THEN CAST(p_size AS DOUBLE) WHEN 1 THEN p_size + 0.5 END AS number, CASE WHEN p_partkey % 2 = 0 THEN p_partkey END AS process,
CASE WHEN contains(p_name, 'bolt') THEN 'metal' WHEN contains(p_name, 'ring') OR contains(p_name, 'gear') THEN 'round' ELSE 'premise' END AS rationale, p_partkey % 5 <> 0 AS same_title, p_partkey % 4 <> 0 AS alias_ok FROM part""")
def file_forms(t):
    p, n = t("part"), F.col("p_partkey")
    size = F.col("p_size").cast("string")
    file = F.when(n % 3 == 0, F.concat(F.lit("["), "p_brand", F.lit(" 0"), size, F.lit("] - x.epub"))).when(n % 3 == 1, F.concat(F.lit("x ("), "p_name", F.lit(", #"), size, F.lit(".5).epub"))).otherwise("plain.epub")
    found = names.series_of_file(file)
    run = F.when(n % 2 == 0, F.concat(F.lit("run-20240101-120000-"), n.cast("string"), F.lit("-2.jsonl"))).otherwise("run-x.jsonl")
    why = sentences_of.rationale_class(F.upper("p_name"), {"metal": "bolt", "round": "ring|gear"}, "premise")
    title = F.concat(F.lit("[Set 1] - "), F.when(n % 5 == 0, "another").otherwise(F.col("p_name")))
    alias = F.when(n % 4 == 0, F.concat("p_brand", F.lit("’s wife"))).otherwise(F.col("p_brand"))
    return p.select("p_partkey", found["series"].alias("series"), found["number"].alias("number"), names.run_process(run).alias("process"), why.alias("rationale"), names.titles_match(F.col("p_name"), title).alias("same_title"), names.valid_alias(alias).alias("alias_ok"))
