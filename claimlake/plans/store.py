"""Store checks, roll-ups, lookups and text scans, each with DuckDB SQL for the same rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..streaming import windows
from .queries import CENTS, cents, query

COUNTED = ("customer", "supplier", "part", "orders", "lineitem", "events")
KINDS = ("click", "error", "purchase", "signup", "view")
HALF = "2024-01-15"
#: What page text leaves out, and the entities it decodes.
UNSEEN = r"(?is)<script.*?</script>|<style.*?</style>|<title.*?</title>|<!--.*?-->"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&"))


@query(" UNION ALL ".join(f"SELECT '{x}' AS name, count(*) AS n FROM {x}" for x in COUNTED))
def table_row_counts(t):
    return reduce(DataFrame.union, (t(x).agg(F.lit(x).alias("name"), F.count(F.lit(1)).alias("n")).select("name", "n") for x in COUNTED))


@query("""SELECT count(*) FILTER (value IS NOT NULL AND (value < 0 OR value > 200)) AS out_of_range,
count(*) FILTER (event_type NOT IN ('view', 'click')) AS other_kind, count(*) FILTER (props IS NULL OR props = '') AS no_props FROM events""")
def column_checks(t):
    out = F.col("value").isNotNull() & ((F.col("value") < 0) | (F.col("value") > 200))
    return t("events").agg(F.count_if(out).alias("out_of_range"), F.count_if(~F.col("event_type").isin("view", "click")).alias("other_kind"), F.count_if(F.col("props").isNull() | (F.col("props") == "")).alias("no_props"))


@query("""SELECT count(*) AS n_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows FROM (SELECT count(*) AS n FROM events GROUP BY user_id, event_type, CAST(ts AS DATE) HAVING count(*) > 1)""")
def duplicate_key_check(t):
    many = t("events").groupBy("user_id", "event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return many.agg(F.count(F.lit(1)).alias("n_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


@query("""WITH own AS (SELECT d.doc_id, text, quality FROM documents d JOIN labels USING (doc_id)), same AS (SELECT text, min(quality) AS quality FROM own GROUP BY 1)
SELECT d.doc_id, coalesce(l.quality, s.quality) AS quality, CASE WHEN l.quality IS NOT NULL THEN 'own' WHEN s.quality IS NOT NULL THEN 'text' ELSE 'none' END AS authority
FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN same s ON s.text = d.text""")
def verdict_authority(t):
    docs = t("documents").select("doc_id", F.sha2("text", 256).alias("hash"))
    labelled = docs.join(t("labels").select("doc_id", "quality"), "doc_id", "left")
    same = labelled.groupBy("hash").agg(F.min("quality").alias("same")).filter("same IS NOT NULL AND hash IS NOT NULL")
    authority = F.when(F.col("quality").isNotNull(), "own").when(F.col("same").isNotNull(), "text").otherwise("none")
    return labelled.join(same, "hash", "left").select("doc_id", F.coalesce("quality", "same").alias("quality"), authority.alias("authority"))


@query("SELECT source, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY ROLLUP (source, lang)")
def pooled_blocks(t):
    return t("documents").rollup("source", "lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars"))


@query(f"SELECT user_id, {', '.join(f'count(*) FILTER (event_type = {k!r}) AS {k}' for k in KINDS)} FROM events GROUP BY 1")
def outcome_pivot(t):
    return t("events").groupBy("user_id").pivot("event_type", list(KINDS)).agg(F.count(F.lit(1))).fillna(0)


@query("""SELECT event_id, coalesce(string_agg(event_type, ',') OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), '') AS seen_before FROM events""")
def state_before(t):
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(-3, -1)
    return t("events").select("event_id", F.array_join(F.collect_list("event_type").over(w), ",").alias("seen_before"))


@query("SELECT user_id, tile, min(event_id) AS picked FROM (SELECT user_id, event_id, CAST(ntile(10) OVER (PARTITION BY user_id ORDER BY event_id) AS INT) AS tile FROM events) GROUP BY 1, 2")
def spread_sample(t):
    tile = F.ntile(10).over(Window.partitionBy("user_id").orderBy("event_id"))
    return t("events").select("user_id", "event_id", tile.alias("tile")).groupBy("user_id", "tile").agg(F.min("event_id").alias("picked"))


@query(f"""WITH k AS (SELECT user_id, event_type, bool_or(ts < TIMESTAMP '{HALF}') AS o, bool_or(ts >= TIMESTAMP '{HALF}') AS n FROM events GROUP BY 1, 2)
SELECT user_id, count(*) FILTER (o AND n) AS shared, count(*) FILTER (n AND NOT o) AS added, count(*) FILTER (o AND NOT n) AS removed, CAST(10000 * count(*) FILTER (o AND n) // count(*) AS BIGINT) AS jaccard FROM k GROUP BY 1""")
def set_agreement(t):
    old = F.expr(f"ts < timestamp_ntz'{HALF}'")
    k = t("events").groupBy("user_id", "event_type").agg(F.bool_or(old).alias("o"), F.bool_or(~old).alias("n"))
    return k.groupBy("user_id").agg(F.expr("count_if(o AND n)").alias("shared"), F.expr("count_if(n AND NOT o)").alias("added"), F.expr("count_if(o AND NOT n)").alias("removed"), F.expr("10000 * count_if(o AND n) div count(1)").alias("jaccard"))


@query(f"""WITH p AS (SELECT page_id, trim(regexp_replace({"replace(" * len(ENTITIES)}regexp_replace(regexp_replace(html, '{UNSEEN}', ' ', 'g'), '<[^>]*>', ' ', 'g'){"".join(f", '{a}', '{b}')" for a, b in ENTITIES)}, '[ \t\n\r]+', ' ', 'g'), ' ') AS body FROM pages)
SELECT page_id, CAST(length(body) AS BIGINT) AS n_chars, md5(body) AS body_hash FROM p""")
def page_text(t):
    body = F.regexp_replace(F.regexp_replace("html", UNSEEN, " "), "<[^>]*>", " ")
    for a, b in ENTITIES:
        body = F.replace(body, F.lit(a), F.lit(b))
    body = F.trim(F.regexp_replace(body, "[ \t\n\r]+", " "))
    return t("pages").select("page_id", F.length(body).cast("long").alias("n_chars"), F.md5(body).alias("body_hash"))


@query("""SELECT token, count(DISTINCT doc_id) AS n_docs, count(*) AS n_hits FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS token FROM documents) WHERE token <> '' GROUP BY 1""")
def token_index(t):
    each = t("documents").select("doc_id", F.explode(F.split("text", " ")).alias("token")).filter("token <> ''")
    return each.groupBy("token", "doc_id").agg(F.count(F.lit(1)).alias("n")).groupBy("token").agg(F.count("doc_id").alias("n_docs"), F.sum("n").alias("n_hits"))


@query("""SELECT c_custkey, o_orderkey AS last_order, o_totalprice AS last_price FROM customer LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) ON o_custkey = c_custkey AND rn = 1""")
def latest_activity(t):
    last = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.struct("o_orderdate", "o_orderkey", "o_totalprice")).alias("o"))
    return t("customer").select("c_custkey").join(last, "c_custkey", "left").select("c_custkey", F.col("o.o_orderkey").alias("last_order"), F.col("o.o_totalprice").alias("last_price"))


@query("""WITH h AS (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL) SELECT a.source AS source_a, b.source AS source_b, count(*) AS n_shared FROM h a JOIN h b ON a.text = b.text AND a.source < b.source GROUP BY 1, 2""")
def source_overlap(t):
    # one row for each source and text, so a text makes no more pairs than pairs of sources
    h = t("documents").filter("text IS NOT NULL").select("source", F.sha2("text", 256).alias("hash")).distinct()
    a, b = h.withColumnRenamed("source", "source_a"), h.withColumnRenamed("source", "source_b")
    return a.join(b, "hash").filter("source_a < source_b").groupBy("source_a", "source_b").agg(F.count(F.lit(1)).alias("n_shared"))


@query("""SELECT user_id, CAST(ts AS DATE) AS day, CASE WHEN count(DISTINCT event_type) = 1 THEN max(event_type) END AS verdict, count(*) AS n, max(value) AS best FROM events GROUP BY 1, 2""")
def restatement_collapse(t):
    lo, hi = F.min("event_type"), F.max("event_type")  # one distinct value: its least is its greatest
    return t("events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.when(lo == hi, hi).alias("verdict"), F.count(F.lit(1)).alias("n"), F.max("value").alias("best"))


@query(f"""SELECT event_type, CAST(2 * median({CENTS.format('value')}) AS BIGINT) AS twice_median, CAST(max({CENTS.format('value')}) - min({CENTS.format('value')}) AS BIGINT) AS spread FROM events GROUP BY 1""")
def median_spread(t):
    return t("events").groupBy("event_type").agg((2 * F.median(cents("value"))).cast("long").alias("twice_median"), (F.max(cents("value")) - F.min(cents("value"))).alias("spread"))


@query("""SELECT time_bucket(INTERVAL '1 hour', ts) AS begins, event_type, count(*) AS n, max(value) AS best FROM events GROUP BY 1, 2""")
def hourly_windows(t):
    return windows.tumbling(t("events"), "ts", ["event_type"], "1 hour", "value")
