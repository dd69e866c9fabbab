"""Names, outputs and passages resolved, each with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import passages
from ..operators import resolution
from .queries import cents, query


@query("""WITH f AS (SELECT event_id * 7 % 997 AS form, 0 AS rank, event_id AS seq, user_id AS key FROM events WHERE event_type = 'purchase' UNION ALL SELECT event_id * 3 % 1499, 1, event_id, user_id FROM events WHERE event_type = 'click'),
b AS (SELECT form, key FROM f QUALIFY row_number() OVER (PARTITION BY form ORDER BY rank, seq, key) = 1)
SELECT event_id, x.key AS from_key, y.key AS to_key, coalesce(x.key = y.key, TRUE) AS skipped FROM events LEFT JOIN b x ON x.form = event_id % 1999 LEFT JOIN b y ON y.form = event_id * 5 % 1999 WHERE event_type = 'view'""")
def alias_endpoints(t):
    e, n = t("events"), F.col("event_id")

    def forms(kind, form, rank):
        return e.filter(F.col("event_type") == kind).select(form.alias("form"), F.lit(rank).alias("rank"), n.alias("at"), F.col("user_id").alias("key"))

    links = e.filter("event_type = 'view'").select("event_id", (n % 1999).alias("a"), (n * 5 % 1999).alias("b"))
    return resolution.through_aliases(links, forms("purchase", n * 7 % 997, 0).unionByName(forms("click", n * 3 % 1499, 1)), "a", "b").drop("a", "b")


@query("""WITH d AS (SELECT doc_id, lang || ' ' || source AS short, lang || ' ' || source || ' ' || (n_chars % 100) AS form FROM documents),
e AS (SELECT CASE WHEN quality = 1 THEN form ELSE short END AS form, 2 * quality + toxic AS entity FROM d JOIN labels USING (doc_id)), n AS (SELECT form, min(entity) AS lo, max(entity) AS hi FROM e WHERE form IS NOT NULL AND entity IS NOT NULL GROUP BY 1),
m AS (SELECT DISTINCT d.form, x.lo, x.hi, x.form AS long, y.lo AS slo, y.hi AS shi, y.form AS short FROM d LEFT JOIN n x ON x.form = d.form LEFT JOIN n y ON y.form = d.short)
SELECT form, CASE WHEN long IS NULL THEN CASE WHEN slo = shi THEN slo END WHEN lo = hi THEN lo END AS entity, CASE WHEN long IS NULL THEN CASE WHEN slo = shi THEN short END WHEN lo = hi THEN long END AS matched FROM m""")
def prefix_entities(t):
    d = t("documents").select("doc_id", F.concat_ws(" ", "lang", "source").alias("short"), F.concat("lang", F.lit(" "), "source", F.lit(" "), (F.col("n_chars") % 100).cast("string")).alias("form"))
    e = d.join(t("labels"), "doc_id").select(F.when(F.col("quality") == 1, F.col("form")).otherwise(F.col("short")).alias("form"), (2 * F.col("quality") + F.col("toxic")).alias("entity"))
    return resolution.by_longest_prefix(d, e, "form")


@query("""WITH q AS (SELECT DISTINCT left(md5(CAST(c_custkey AS VARCHAR)), 4) AS prefix FROM customer), w AS (SELECT left(md5(CAST(o_orderkey AS VARCHAR)), 4) AS prefix, min(md5(CAST(o_orderkey AS VARCHAR))) AS lo, max(md5(CAST(o_orderkey AS VARCHAR))) AS hi FROM orders GROUP BY 1)
SELECT prefix, CASE WHEN lo = hi THEN lo END AS work FROM q LEFT JOIN w USING (prefix)""")
def works_by_prefix(t):
    works = t("orders").select(F.md5(F.col("o_orderkey").cast("string")).alias("work"))
    return resolution.by_id_prefix(t("customer").select(F.substring(F.md5(F.col("c_custkey").cast("string")), 1, 4).alias("prefix")), works, "prefix", "work")


_TIER = """{n}_a AS (SELECT form, min(o) AS o, min(n) AS n FROM (SELECT {c} AS form, doc_id AS o, NULL AS n FROM o {w1} UNION ALL SELECT {c}, NULL, doc_id FROM n {w2}) WHERE form IS NOT NULL GROUP BY 1 HAVING min(o) = max(o) AND min(n) = max(n)),
{n} AS (SELECT min(o) AS o, n FROM (SELECT o, min(n) AS n FROM {n}_a GROUP BY 1 HAVING min(n) = max(n)) GROUP BY n HAVING min(o) = max(o))"""
_SECOND, _THIRD = ({"w1": f"WHERE doc_id NOT IN ({' UNION ALL '.join(f'SELECT o FROM {p}' for p in done)})", "w2": f"WHERE doc_id NOT IN ({' UNION ALL '.join(f'SELECT n FROM {p}' for p in done)})"} for done in (["t0"], ["t0", "t1"]))


@query(f"""WITH d AS (SELECT doc_id, quality, md5(text) AS a, source || ':' || n_chars AS b, source || ':' || lang || ':' || n_chars // 10 AS c FROM documents JOIN labels USING (doc_id)), o AS (SELECT * FROM d WHERE quality = 1), n AS (SELECT * FROM d WHERE quality = 0),
{_TIER.format(n='t0', c='a', w1='', w2='')}, {_TIER.format(n='t1', c='b', **_SECOND)}, {_TIER.format(n='t2', c='c', **_THIRD)}
SELECT o AS old_doc_id, n AS new_doc_id, 0 AS tier FROM t0 UNION ALL SELECT o, n, 1 FROM t1 UNION ALL SELECT o, n, 2 FROM t2""")
def matched_across_runs(t):
    d = t("documents").join(t("labels"), "doc_id")
    d = d.select("doc_id", "quality", F.md5("text").alias("a"), F.concat("source", F.lit(":"), F.col("n_chars").cast("string")).alias("b"), F.concat("source", F.lit(":"), "lang", F.lit(":"), F.expr("string(n_chars div 10)")).alias("c"))
    return resolution.by_tiers(d.filter("quality = 1"), d.filter("quality = 0"), "doc_id", ["a", "b", "c"])


_OUTPUTS = "SELECT o_custkey, o_orderpriority, max(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM orders WHERE o_orderstatus <> '{}' GROUP BY 1, 2"


@query(f"""WITH o AS ({_OUTPUTS.format('F')}), n AS ({_OUTPUTS.format('O')})
SELECT coalesce(o.o_custkey, n.o_custkey) AS o_custkey, coalesce(o.o_orderpriority, n.o_orderpriority) AS o_orderpriority, CASE WHEN n.o_custkey IS NULL THEN 'deleted' WHEN o.cents = n.cents THEN 'reused' ELSE 'written' END AS action
FROM o FULL JOIN n ON o.o_custkey = n.o_custkey AND o.o_orderpriority = n.o_orderpriority""")
def settled_outputs(t):
    def outputs(status):
        return t("orders").filter(F.col("o_orderstatus") != status).groupBy("o_custkey", "o_orderpriority").agg(F.max(cents("o_totalprice")).alias("cents"))

    return resolution.settled(outputs("F"), outputs("O"), ["o_custkey", "o_orderpriority"], "cents")


@query("""SELECT o_orderkey, coalesce(['shipped', 'staged', 'dropped'][r], 'absent') AS state FROM orders LEFT JOIN
(SELECT l_orderkey, min(CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END) AS r FROM lineitem WHERE l_returnflag IN ('R', 'A') OR l_linestatus = 'F' GROUP BY 1) ON o_orderkey = l_orderkey""")
def claim_states(t):
    lines = t("lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    places = {"shipped": lines.filter("l_returnflag = 'R'"), "staged": lines.filter("l_returnflag = 'A'"), "dropped": lines.filter("l_linestatus = 'F'")}
    return resolution.placed(t("orders").select("o_orderkey"), places, ["o_orderkey"])


@query("""SELECT user_id, chapter, count(*) AS n_new FROM (SELECT user_id, event_type, min(CAST(day(ts) AS INT)) AS chapter FROM events WHERE ts IS NOT NULL AND event_type IS NOT NULL GROUP BY 1, 2) GROUP BY 1, 2""")
def new_names_by_chapter(t):
    return resolution.new_names(t("events").withColumn("chapter", F.dayofmonth("ts")), ["user_id"], "event_type", "chapter")


@query("""WITH s AS (SELECT lower(source) AS title, min(CASE WHEN toxic = 1 THEN 'held_out' ELSE 'tuning' END) AS split FROM documents JOIN labels USING (doc_id) WHERE quality = 0 AND source IS NOT NULL GROUP BY 1)
SELECT doc_id, coalesce(split, 'train') AS split FROM documents LEFT JOIN s ON lower(source) = title""")
def split_assignment(t):
    labelled = t("documents").join(t("labels").filter("quality = 0"), "doc_id").select(F.upper("source").alias("source"), F.when(F.col("toxic") == 1, "held_out").otherwise("tuning").alias("split"))
    return resolution.split_of(t("documents").select("doc_id", "source"), labelled, "source").select("doc_id", "split")


@query("""WITH s AS (SELECT lang, round(least(1.0, n_chars / 4000.0), 5)::DOUBLE AS s FROM documents WHERE n_chars IS NOT NULL)
SELECT lang, n, CAST(p AS INT) AS decile, round(q[p], 6) AS score FROM (SELECT lang, count(*) AS n, quantile_cont(s, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM s GROUP BY 1), range(1, 10) r(p)""")
def score_deciles(t):
    d = resolution.deciles(t("documents").select("lang", F.least(F.lit(1.0), F.col("n_chars") / 4000.0).alias("s")), ["lang"], "s", places=5)
    return d.select("lang", "n", F.posexplode("deciles").alias("p", "q")).select("lang", "n", (F.col("p") + 1).alias("decile"), F.round("q", 6).alias("score"))


@query(r"""WITH p AS (SELECT doc_id, text, unnest(string_split(regexp_replace(replace(text, chr(1), ' '), '([.!?][ \t\n\r\f\v]+)', '\1' || chr(1), 'g'), chr(1))) AS s, generate_subscripts(string_split(regexp_replace(replace(text, chr(1), ' '), '([.!?][ \t\n\r\f\v]+)', '\1' || chr(1), 'g'), chr(1)), 1) AS i FROM documents WHERE text <> ''),
e AS (SELECT doc_id, i, length(s) AS n, coalesce(sum(length(s)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM p WHERE s <> ''),
c AS (SELECT doc_id, pos + 600 * k AS start, least(pos + n, pos + 600 * k + 600) AS stop FROM (SELECT *, unnest(range(0, (n + 599) // 600)) AS k FROM e)),
w AS (SELECT a.doc_id, a.start, max(b.stop) AS stop FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.start >= a.start AND b.stop <= a.start + 600 GROUP BY 1, 2)
SELECT doc_id, CAST(start AS INT) AS start, CAST(stop AS INT) AS stop, md5(substr(text, CAST(start + 1 AS BIGINT), CAST(stop - start AS BIGINT))) AS passage_hash
FROM (SELECT *, lag(stop) OVER (PARTITION BY doc_id ORDER BY start) AS before FROM w) JOIN documents USING (doc_id) WHERE before IS NULL OR stop > before""")
def passage_windows(t):
    d = t("documents").select("doc_id", "text", F.explode(passages.passages("text")).alias("w"))
    return d.select("doc_id", "w.start", "w.stop", F.md5(F.substring(F.col("text"), F.col("w.start") + 1, F.col("w.stop") - F.col("w.start"))).alias("passage_hash"))
