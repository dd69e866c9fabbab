"""Rosters, identities, comparisons of two runs, near vectors and chapters over the given tables. Each query has DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import comparison, roster, vectors
from ..sources import chapters
from .queries import query


def _people(t):
    """Persons that events stand for: a user is a book, a day a chapter."""
    n = F.col("event_id")
    name = F.concat(F.when(n % 2 == 0, "The N").otherwise("n"), (n % 7).cast("string"))
    return t("events").select(F.col("user_id").alias("book"), F.dayofmonth("ts").alias("chapter"), n.alias("pos"), name.alias("name"), F.array(F.concat(F.lit("n"), (n % 11).cast("string"))).alias("aliases"), F.when(n % 3 == 0, F.col("event_type")).alias("evidence"))


_PEOPLE = """p AS (SELECT user_id AS book, CAST(day(ts) AS INT) AS chapter, event_id AS pos, day(ts) * 1000000000 + event_id AS pos_, 'n' || (event_id % 7) AS key, CASE WHEN event_id % 2 = 0 THEN 'The N' ELSE 'n' END || (event_id % 7) AS name, 'n' || (event_id % 11) AS alias, CASE WHEN event_id % 3 = 0 THEN event_type END AS evidence FROM events),
o AS (SELECT book, key, min(pos_) AS first, arg_min(name, pos_) AS name, arg_min(chapter, pos_) AS since FROM p GROUP BY 1, 2),
f AS (SELECT p.book, p.key, p.alias, x.first IS NULL OR x.first > p.pos_ OR p.alias = p.key AS adopted, min(p.pos_) AS at_, min(p.chapter) AS chapter FROM p JOIN o ON o.book = p.book AND o.key = p.key LEFT JOIN o AS x ON x.book = p.book AND x.key = p.alias WHERE p.alias <> o.name GROUP BY ALL),
c AS (SELECT DISTINCT book, chapter FROM p), g AS (SELECT c.book, c.chapter, o.key, o.name, o.first FROM c JOIN o ON c.book = o.book AND o.since < c.chapter)"""


@query(f"""WITH {_PEOPLE}, a AS (SELECT g.book, g.chapter, g.key, count(*) AS appearances, count(DISTINCT p.chapter) AS chapters, max(p.chapter) AS last_seen, arg_min(p.evidence, p.pos_) FILTER (p.evidence IS NOT NULL) AS evidence FROM g JOIN p ON p.book = g.book AND p.key = g.key AND p.chapter < g.chapter GROUP BY 1, 2, 3),
l AS (SELECT g.book, g.chapter, g.key, string_agg(alias, ',' ORDER BY at_) FILTER (adopted) AS aliases, string_agg(alias, ',' ORDER BY at_) FILTER (NOT adopted) AS unresolved FROM g JOIN f ON f.book = g.book AND f.key = g.key AND f.chapter < g.chapter GROUP BY 1, 2, 3)
SELECT a.book, a.chapter, a.key, g.name, appearances, chapters, CAST(last_seen AS INT) AS last_seen, coalesce(aliases, '') AS aliases, coalesce(unresolved, '') AS unresolved, evidence, CAST(row_number() OVER (PARTITION BY a.book, a.chapter ORDER BY g.first) - 1 AS INT) AS place
FROM a JOIN g ON g.book = a.book AND g.chapter = a.chapter AND g.key = a.key LEFT JOIN l ON l.book = a.book AND l.chapter = a.chapter AND l.key = a.key""")
def roster_states(t):
    p = _people(t)
    out = roster.states_before(p, p.select("book", "chapter"), "book", "chapter", "pos")
    return out.withColumns({c: F.array_join(c, ",") for c in ("aliases", "unresolved")})


@query(f"""WITH {_PEOPLE}, r AS (SELECT book, chapter, count(*) AS roster_size FROM g GROUP BY 1, 2), k AS (SELECT user_id AS book, CAST(day(ts) AS INT) AS chapter, event_id % 7 AS a, event_id % 5 AS b, event_type AS type FROM events),
d AS (SELECT DISTINCT user_id AS book, event_id % 7 AS a, event_id % 5 AS b, event_type AS type FROM events WHERE event_id % 2 = 0), j AS (SELECT k.book, k.chapter, count(d.a) AS joined, count(*) - count(d.a) AS unjoined FROM k LEFT JOIN d USING (book, a, b, type) GROUP BY 1, 2)
SELECT c.book, c.chapter, CASE WHEN c.chapter % 4 = 0 THEN 'unavailable' ELSE 'corpus' END AS text_source, coalesce(roster_size, 0) AS roster_size, joined, unjoined FROM c LEFT JOIN r USING (book, chapter) JOIN j USING (book, chapter)""")
def harvest_pairs(t):
    p, e = _people(t), t("events")
    pages = p.select("book", "chapter", F.when(F.col("chapter") % 4 != 0, F.lit("text")).alias("text")).distinct()
    ends = [F.col("user_id").alias("book"), (F.col("event_id") % 7).cast("string").alias("from"), (F.col("event_id") % 5).cast("string").alias("to"), F.col("event_type").alias("type")]
    outcomes = e.filter("event_id % 2 = 0").select(*ends, F.lit("shipped").alias("disposition"))
    claims = e.select(*ends, F.dayofmonth("ts").alias("chapter"))
    return roster.extraction_pairs(pages, roster.states_before(p, pages, "book", "chapter", "pos"), claims, outcomes, "book", "chapter").drop("text", "roster")


@query("""WITH v AS (SELECT user_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'The ' || event_type END AS form, CAST(floor(value) AS BIGINT) AS n, event_id AS run FROM events WHERE event_id % 10 <> 0),
f AS (SELECT user_id, form, sum(n) AS n, max(run) AS run FROM v GROUP BY 1, 2), t AS (SELECT *, max(n) OVER (PARTITION BY user_id) AS top FROM f)
SELECT user_id, form FROM t WHERE n >= 0.8 * top QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY len(string_split(form, ' ')) DESC, length(form) DESC, run DESC, form) = 1""")
def canonical_forms(t):
    form = F.when(F.col("event_id") % 2 == 0, F.col("event_type")).otherwise(F.concat(F.lit("The "), "event_type"))
    seen = t("events").select("user_id", form.alias("form"), F.floor("value").alias("n"), F.col("event_id").alias("run"))
    return roster.canonical_names(seen, ["user_id"], "form", "n", "run", F.col("run") % 10 == 0)


@query("SELECT user_id, event_id, CAST(coalesce(base, 0) + row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS id FROM events LEFT JOIN (SELECT o_custkey AS user_id, max(o_orderkey) AS base FROM orders GROUP BY 1) USING (user_id)")
def minted_ids(t):
    known = t("orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("id"))
    return roster.minted(t("events").select("user_id", "event_id"), known, "user_id", ["event_id"])


@query("WITH r AS (SELECT o_custkey, o_orderkey AS id, max(o_orderkey) OVER (PARTITION BY o_custkey) AS final FROM orders) SELECT * FROM r WHERE id <> final")
def redirect_chains(t):
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return roster.resolved(t("orders").select("o_custkey", F.col("o_orderkey").alias("id"), F.lead("o_orderkey").over(w).alias("to")), "o_custkey")


@query("""WITH c AS (SELECT c_custkey, 1 + max(coalesce(o_orderkey, 0)) % 5 + count(o_orderkey) AS minted FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1), s AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS active, count(*) FILTER (o_orderstatus = 'O') AS split, count(*) FILTER (o_orderstatus = 'P') AS merged FROM orders GROUP BY 1)
SELECT c_custkey, minted, coalesce(active, 0) AS active, coalesce(split, 0) AS split, coalesce(merged, 0) AS merged, minted - coalesce(active, 0) - coalesce(split, 0) - coalesce(merged, 0) AS unaccounted FROM c LEFT JOIN s ON o_custkey = c_custkey""")
def id_accounts(t):
    o = t("orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", "active").when(F.col("o_orderstatus") == "O", "split").alias("status"))
    counters = t("customer").select("c_custkey").join(o, "c_custkey", "left").groupBy("c_custkey").agg((1 + F.max(F.coalesce("id", F.lit(0))) % 5 + F.count("id")).alias("minted"))
    return roster.id_account(o, o.filter("status IS NULL"), counters, "c_custkey")


_FLIPS = """o AS (SELECT DISTINCT p_brand AS work, p_name AS name FROM part WHERE p_partkey % 2 = 0 AND p_size > 20), n AS (SELECT DISTINCT p_brand AS work, CASE WHEN p_size % 2 = 0 THEN p_name ELSE 'old ' || p_name END AS name FROM part WHERE p_partkey % 2 = 1 AND p_size > 20),
a AS (SELECT * FROM o EXCEPT SELECT * FROM n), b AS (SELECT * FROM n EXCEPT SELECT * FROM o), w AS (SELECT p_brand AS work, p_name AS form, arg_min(split_part(p_name, ' ', 1), p_partkey) AS owner FROM part GROUP BY 1, 2)"""


@query(f"""WITH {_FLIPS}, x AS (SELECT a.work, a.name AS old, b.name AS new, string_split(a.name, ' ') AS s, string_split(b.name, ' ') AS t FROM a JOIN b ON a.work = b.work)
SELECT x.work, old, new, CASE WHEN (len(list_distinct(s)) < len(list_distinct(t)) AND list_has_all(t, s)) OR (len(list_distinct(t)) < len(list_distinct(s)) AND list_has_all(s, t)) THEN 'token-subset' ELSE 'alias-linked' END AS reason FROM x LEFT JOIN w AS v ON v.work = x.work AND v.form = x.old LEFT JOIN w AS u ON u.work = x.work AND u.form = x.new
WHERE (len(list_distinct(s)) < len(list_distinct(t)) AND list_has_all(t, s)) OR (len(list_distinct(t)) < len(list_distinct(s)) AND list_has_all(s, t)) OR coalesce(v.owner = x.new, FALSE) OR coalesce(u.owner = x.old, FALSE)""")
def preview_form_flips(t):
    p = t("part").withColumnRenamed("p_brand", "work")
    old = p.filter("p_partkey % 2 = 0 AND p_size > 20").select("work", F.col("p_name").alias("name"))
    new = p.filter("p_partkey % 2 = 1 AND p_size > 20").select("work", F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(F.concat(F.lit("old "), "p_name")).alias("name"))
    forms = p.select("work", F.substring_index("p_name", " ", 1).alias("owner"), F.col("p_name").alias("form"), F.col("p_partkey").alias("pos"))
    return comparison.form_flips(old, new, forms, forms, "work")


@query("""WITH e AS (SELECT user_id, event_id, unnest(['N' || (event_id % 9), 'the n' || (event_id % 4)]) AS name, unnest([0, 1]) AS e FROM events), f AS (SELECT DISTINCT user_id, 'n' || (event_id % 7) AS form FROM events WHERE event_type = 'view'),
l AS (SELECT e.* FROM e ANTI JOIN f ON e.user_id = f.user_id AND regexp_replace(lower(e.name), '^the ', '') = f.form), n AS (SELECT user_id, name, min(event_id * 2 + e) AS first FROM l GROUP BY 1, 2),
s AS (SELECT user_id, string_agg(name, ',' ORDER BY first) AS names FROM n GROUP BY 1), b AS (SELECT user_id, count(DISTINCT event_id) AS bad FROM l GROUP BY 1), t AS (SELECT user_id, count(*) AS claims FROM events GROUP BY 1)
SELECT user_id, claims, coalesce(bad, 0) AS bad, coalesce(names, '') AS names FROM t LEFT JOIN s USING (user_id) LEFT JOIN b USING (user_id)""")
def preview_lost_ends(t):
    n = F.col("event_id")
    claims = t("events").select("user_id", "event_id", F.concat(F.lit("N"), (n % 9).cast("string")).alias("from"), F.concat(F.lit("the n"), (n % 4).cast("string")).alias("to"))
    forms = t("events").filter("event_type = 'view'").select("user_id", F.concat(F.lit("n"), (n % 7).cast("string")).alias("form"))
    return comparison.unresolved_ends(claims, forms, "user_id", "event_id").withColumn("names", F.array_join("names", ","))


_CLAIMED = """f AS (SELECT DISTINCT p_brand AS work, p_size AS entry, CASE WHEN p_partkey % 3 = 0 THEN split_part(p_name, ' ', 1) ELSE p_name END AS form FROM part), e AS (SELECT DISTINCT p_brand AS work, p_name AS entity FROM part WHERE p_partkey % 4 = 0),
m AS (SELECT DISTINCT f.work, form, entity FROM f JOIN e ON f.work = e.work AND (form = entity OR starts_with(form, entity || ' ') OR starts_with(entity, form || ' '))), u AS (SELECT work, form, min(entity) AS entity FROM m GROUP BY 1, 2 HAVING count(*) = 1),
k AS (SELECT DISTINCT f.work, entry, entity FROM f JOIN u ON f.work = u.work AND f.form = u.form)"""


@query(f"""WITH {_CLAIMED} SELECT work, 'merge' AS kind, CAST(entry AS VARCHAR) AS subject, string_agg(entity, ',' ORDER BY entity) AS others FROM k GROUP BY work, entry HAVING count(*) >= 2
UNION ALL SELECT work, 'split', entity, string_agg(CAST(entry AS VARCHAR), ',' ORDER BY CAST(entry AS VARCHAR)) FROM k GROUP BY work, entity HAVING count(*) >= 2""")
def preview_identities(t):
    p = t("part").withColumnRenamed("p_brand", "work")
    forms = p.select("work", F.col("p_size").alias("entry"), F.when(F.col("p_partkey") % 3 == 0, F.substring_index("p_name", " ", 1)).otherwise(F.col("p_name")).alias("form"))
    entities = p.filter("p_partkey % 4 = 0").select("work", F.col("p_name").alias("entity"))
    return comparison.identity_indicators(forms, entities, "work").withColumn("others", F.array_join("others", ","))


@query("SELECT user_id, event_type = 'view' AS family, count(*) FILTER (event_id % 3 = 0) AS empty, count(*) AS total FROM events GROUP BY 1, 2")
def preview_empty_evidence(t):
    kind = F.when(F.col("event_type") == "view", "Parent").otherwise(F.col("event_type"))
    claims = t("events").select("user_id", kind.alias("type"), F.when(F.col("event_id") % 3 == 0, " ").otherwise("quote").alias("evidence"))
    return comparison.empty_evidence(claims, "user_id")


@query("""WITH a AS (SELECT user_id, event_type, min(CAST(floor(value / 10) AS INT)) AS old FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2), b AS (SELECT user_id, event_type, min(CAST(floor(value / 10) AS INT)) AS new FROM events WHERE event_id % 2 = 1 GROUP BY 1, 2)
SELECT user_id, event_type, old, new FROM a JOIN b USING (user_id, event_type) WHERE old <> new""")
def preview_prominence(t):
    e = t("events").withColumn("band", F.floor(F.col("value") / 10).cast("int"))
    return comparison.prominence_changes(e.filter("event_id % 2 = 0"), e.filter("event_id % 2 = 1"), ["user_id", "event_type"], "band")


_COSINE = """v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), u AS (SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS l FROM v)"""


@query(f"""WITH {_COSINE}, p AS (SELECT a.vec_id AS a, b.vec_id AS b, list_dot_product(a.v, b.v) / (a.l * b.l) AS cosine FROM u AS a JOIN u AS b ON a.vec_id < b.vec_id) SELECT a, b, round(cosine, 6) AS cosine FROM p WHERE cosine >= 0.4""")
def near_vectors(t):
    return vectors.near_pairs(t("embeddings"), "vec_id", "embedding", 0.4).withColumn("cosine", F.round("cosine", 6))


@query(f"""WITH {_COSINE}, p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u AS a JOIN u AS b ON a.vec_id < b.vec_id WHERE list_dot_product(a.v, b.v) / (a.l * b.l) >= 0.4 AND a.label = b.label AND a.vec_id // 4 <> b.vec_id // 4)
SELECT a, b, 'vector' AS signal FROM p UNION ALL SELECT min(vec_id) OVER (PARTITION BY vec_id // 4), vec_id, 'name' FROM embeddings QUALIFY min(vec_id) OVER (PARTITION BY vec_id // 4) <> vec_id""")
def person_links(t):
    people = t("embeddings").select("vec_id", F.concat(F.lit("n"), F.expr("vec_id div 4").cast("string")).alias("name"), "label")
    pairs = vectors.near_pairs(t("embeddings"), "vec_id", "embedding", 0.4)
    return vectors.two_signal_links(people, pairs, "vec_id", "name", allowed=F.col("a_label") == F.col("b_label"))


@query(f"""WITH {_COSINE}, c AS (SELECT 'label ' || lpad(CAST(vec_id AS VARCHAR), 3, '0') AS name, v, l FROM u WHERE vec_id < 40), s AS (SELECT u.vec_id, c.name, list_dot_product(u.v, c.v) / (u.l * c.l) AS cosine FROM u, c)
SELECT vec_id, CASE WHEN max(cosine) >= 0.3 THEN arg_max(name, cosine) END AS name, CASE WHEN max(cosine) >= 0.3 THEN round(max(cosine), 6) END AS cosine FROM s GROUP BY 1""")
def catalog_labels(t):
    catalog = t("embeddings").filter("vec_id < 40").select(F.concat(F.lit("label "), F.lpad(F.col("vec_id").cast("string"), 3, "0")).alias("name"), "embedding")
    return vectors.best_in_catalog(t("embeddings"), catalog, "vec_id", "name", "embedding", 0.3).withColumn("cosine", F.round("cosine", 6))


@query("""WITH RECURSIVE d AS (SELECT lang || source AS work, doc_id, n_chars, row_number() OVER (PARTITION BY lang || source ORDER BY doc_id) AS k FROM documents),
r AS (SELECT work, doc_id, k, n_chars AS held, 1 AS chapter FROM d WHERE k = 1 UNION ALL SELECT d.work, d.doc_id, d.k, CASE WHEN r.held >= 1500 THEN 0 ELSE r.held END + d.n_chars, r.chapter + CAST(r.held >= 1500 AS INT) FROM r JOIN d ON d.work = r.work AND d.k = r.k + 1),
l AS (SELECT work, max(chapter) AS last, max(chapter) FILTER (held >= 1500) AS ended FROM r GROUP BY 1)
SELECT doc_id, CAST(least(chapter, greatest(1, coalesce(ended, 1))) AS INT) AS chapter FROM r JOIN l USING (work)""")
def unit_chapters(t):
    units = t("documents").select(F.concat("lang", "source").alias("work"), "doc_id", "n_chars")
    return chapters.grouped(units, "work", "doc_id", "n_chars").select("doc_id", "chapter")


_NAMED = """n AS (SELECT p_partkey, p_brand, p_name, lag(p_name) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS before, p_size FROM part)"""


@query(f"""WITH {_NAMED}, x AS (SELECT p_partkey, string_split(p_name, ' ') AS p, string_split(regexp_replace(before, '^((the|late|former|young|old|poor|dear) )+', ''), ' ') AS q, p_size % 10 = 0 AS together FROM n WHERE before IS NOT NULL)
SELECT p_partkey, CASE WHEN p = q THEN 'yes' WHEN together THEN 'no' WHEN len(p) >= 2 AND len(q) >= 2 AND p[-1] = q[-1] AND p[1] <> q[1] AND NOT (left(p[1], 1) = left(q[1], 1) AND least(length(p[1]), length(q[1])) >= 4 AND levenshtein(p[1], q[1]) <= 2) THEN 'no' ELSE 'ambiguous' END AS tier FROM x""")
def merge_tiers(t):
    from pyspark.sql import Window

    from ..operators import merging

    before = F.lag("p_name").over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    n = t("part").withColumn("before", before).filter("before IS NOT NULL")
    return n.select("p_partkey", merging.merge_tier(F.concat(F.lit("The late Dr. "), "p_name"), F.col("before"), F.col("p_size") % 10 == 0).alias("tier"))


@query("""WITH x AS (SELECT DISTINCT p_brand AS work, p_name AS k, string_split(p_name, ' ') AS w FROM part)
SELECT a.work, a.k AS a, b.k AS b FROM x AS a JOIN x AS b ON a.work = b.work AND a.k < b.k AND a.w[-1] = b.w[-1]""")
def nominated_pairs(t):
    from ..operators import merging

    people = t("part").select(F.col("p_brand").alias("work"), F.col("p_name").alias("name"))
    return merging.nominated(people, "work", "name").filter(F.array_contains("signals", "shared_surname")).select("work", "a", "b")
