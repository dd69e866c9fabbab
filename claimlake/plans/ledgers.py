"""Moves, plans, comparisons and queues of a store of claims, each with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ledger
from .queries import query


@query("""WITH m AS (SELECT o_orderkey AS g, 1 AS old, 3 AS new FROM orders WHERE o_orderstatus = 'F'), k AS (SELECT l.* FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM m WHERE g = l_orderkey AND new = l_linenumber))
SELECT l_orderkey, CAST(coalesce(new, l_linenumber) AS INT) AS l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM k LEFT JOIN m ON g = l_orderkey AND old = l_linenumber""")
def rekeyed_lines(t):
    moves = t("orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("old"), F.lit(3).alias("new"))
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"))
    return ledger.rekeyed(lines, "l_orderkey", "l_linenumber", moves)


@query("""WITH o AS (SELECT o_custkey, o_orderkey % 97 AS k, coalesce(o_orderpriority <> '2-HIGH' AND CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'P' THEN NULL ELSE CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'pending' END END NOT IN ('', 'confirmed'), FALSE) AS del FROM orders), n AS (SELECT l_suppkey AS o_custkey, l_orderkey % 97 AS k FROM lineitem WHERE l_returnflag = 'A'),
b AS (SELECT o_custkey, count(*) FILTER (del) AS deleted, count(*) FILTER (NOT del) AS preserved FROM o WHERE o_custkey IN (SELECT o_custkey FROM n) GROUP BY 1), h AS (SELECT DISTINCT o_custkey, k FROM o WHERE NOT del),
a AS (SELECT n.o_custkey, count(*) FILTER (h.k IS NULL) AS inserted, count(h.k) AS held_back FROM n LEFT JOIN h ON n.o_custkey = h.o_custkey AND n.k = h.k GROUP BY 1)
SELECT o_custkey, coalesce(deleted, 0) AS deleted, coalesce(preserved, 0) AS preserved, inserted, held_back FROM a LEFT JOIN b USING (o_custkey)""")
def write_plans(t):
    status = F.when(F.col("o_orderstatus") == "F", "confirmed").when(F.col("o_orderstatus") == "O", F.when(F.col("o_orderkey") % 3 == 0, "").otherwise("pending"))
    old = t("orders").select("o_custkey", (F.col("o_orderkey") % 97).alias("k"), "o_orderpriority", status.alias("status"))
    new = t("lineitem").filter("l_returnflag = 'A'").select(F.col("l_suppkey").alias("o_custkey"), (F.col("l_orderkey") % 97).alias("k"))
    return ledger.write_plan(old, new, ["o_custkey", "k"], ["o_custkey"], F.col("o_orderpriority") != "2-HIGH", F.col("status"))


@query("""WITH c AS (SELECT user_id, event_id, 'n' || (event_id % 7) AS a, 'n' || (event_id * 3 % 5) AS b, event_type = 'purchase' AS family, CAST(floor(value) AS BIGINT) AS evidence FROM events)
SELECT user_id, least(a, b) || '|' || greatest(a, b) AS pair, arg_min(event_id, [CASE WHEN family THEN 0 ELSE 1 END, -evidence, event_id]) AS event_id, count(*) AS stood, count(*) FILTER (family) AS family_claims FROM c GROUP BY 1, 2""")
def claims_by_pair(t):
    n = F.col("event_id")
    c = t("events").select("user_id", "event_id", "event_type", F.concat(F.lit("n"), (n % 7).cast("string")).alias("a"), F.concat(F.lit("n"), (n * 3 % 5).cast("string")).alias("b"), F.floor("value").alias("evidence"))
    best = ledger.one_a_pair(c, ["user_id"], "a", "b", F.col("event_type") == "purchase", "evidence", [n])
    return best.select("user_id", F.concat_ws("|", F.least("a", "b"), F.greatest("a", "b")).alias("pair"), "event_id", "stood", "family_claims")


@query("""WITH w AS (SELECT source, count(*) FILTER (n_chars > 0) AS chapters, CAST(coalesce(sum(n_chars // 600), 0) AS BIGINT) AS passages, CAST(coalesce(sum(CASE WHEN lang = 'en' THEN n_chars // 600 ELSE 0 END), 0) AS BIGINT) AS vectors, max(lang) AS parser FROM documents GROUP BY 1)
SELECT source, CASE WHEN chapters = 0 AND passages = 0 THEN 'absent' WHEN passages = 0 THEN 'ingesting' WHEN vectors = 0 THEN 'text_complete' WHEN vectors < passages THEN 'vectors_partial' ELSE 'complete' END AS state, parser IS NULL OR parser <> 'fr' AS stale FROM w""")
def work_states(t):
    size = F.expr("n_chars div 600")
    w = t("documents").groupBy("source").agg(F.count_if(F.col("n_chars") > 0).alias("chapters"), F.sum(size).alias("passages"), F.sum(F.when(F.col("lang") == "en", size).otherwise(0)).alias("vectors"), F.max("lang").alias("parser"))
    return ledger.completeness(w, "source", "chapters", "passages", "vectors", "parser", "fr")


_FIELDS = """o AS (SELECT DISTINCT user_id, event_type AS field, day(ts) % 5 AS item FROM events WHERE event_id % 2 = 0), n AS (SELECT DISTINCT user_id, event_type AS field, CASE WHEN value >= 5 THEN day(ts) % 5 END AS item FROM events WHERE event_id % 2 = 1),
u AS (SELECT user_id, field, item, bool_or(a) AS a, bool_or(NOT a) AS b FROM (SELECT *, TRUE AS a FROM o UNION ALL SELECT *, FALSE FROM n) GROUP BY 1, 2, 3),
g AS (SELECT user_id, field, count(item) FILTER (a AND b) AS shared, count(item) FILTER (b AND NOT a) AS added, count(item) FILTER (a AND NOT b) AS removed, bool_or(a) AND bool_or(b) AS twice FROM u GROUP BY 1, 2),
s AS (SELECT user_id, field, shared, added, removed, CASE WHEN twice THEN CASE WHEN shared + added + removed = 0 THEN 1.0 ELSE shared / (shared + added + removed) END END AS score FROM g)"""


def _fields(t):
    e = t("events").withColumn("item", F.dayofmonth("ts") % 5).withColumnRenamed("event_type", "field")
    return ledger.field_agreement(e.filter("event_id % 2 = 0"), e.filter("event_id % 2 = 1").withColumn("item", F.when(F.col("value") >= 5, F.col("item"))), ["user_id"], "field", "item")


@query(f"WITH {_FIELDS} SELECT user_id, field, shared, added, removed, round(score, 6) AS score FROM s")
def preview_fields(t):
    return _fields(t).withColumn("score", F.round("score", 6))


@query(f"WITH {_FIELDS} SELECT user_id, round(avg(score), 6) AS overall, count(score) AS fields FROM s GROUP BY 1")
def preview_overall(t):
    return ledger.overall(_fields(t), ["user_id"]).withColumn("overall", F.round("overall", 6))


@query("""WITH c AS (SELECT user_id, event_id, event_id * 37 % 101 AS p, event_type = 'error' AS fam FROM events WHERE event_id % 9 <> 0), d AS (SELECT *, CASE WHEN fam THEN least(abs(p - 30), abs(p - 70)) ELSE abs(p - 85) END AS far FROM c),
n AS (SELECT *, far <= 10 AND (NOT fam OR p BETWEEN 30 AND 70) AS near FROM d), r AS (SELECT *, row_number() OVER (PARTITION BY user_id, near ORDER BY CASE WHEN near THEN far ELSE 0 END, md5('7' || event_id), event_id) AS i FROM n)
SELECT user_id, event_id, CASE WHEN NOT near THEN 'control' WHEN fam THEN 'near_band_edge' ELSE 'near_bar' END AS reason, CAST(i AS INT) AS place FROM r WHERE i <= CASE WHEN near THEN 16 ELSE 4 END""")
def labelling_batches(t):
    n = F.col("event_id")
    c = t("events").select("user_id", "event_id", "event_type", F.when(n % 9 != 0, (n * 37 % 101) / 100.0).alias("p"))
    return ledger.labelling_batch(c, "user_id", "event_id", "p", F.col("event_type") == "error", seed="7").select("user_id", "event_id", "reason", "place")


@query("""WITH g AS (SELECT user_id, event_type, max(event_id) AS last, count(*) AS n, CAST(sum(length(props)) AS BIGINT) AS tokens FROM events GROUP BY 1, 2), r AS (SELECT *, sum(tokens) OVER (PARTITION BY user_id ORDER BY last DESC, n DESC, event_type) AS used FROM g)
SELECT user_id, event_type, last, n, tokens, CAST(used AS BIGINT) AS used FROM r WHERE used <= 400""")
def roster_in_prompt(t):
    g = t("events").groupBy("user_id", "event_type").agg(F.max("event_id").alias("last"), F.count(F.lit(1)).alias("n"), F.sum(F.length("props")).alias("tokens"))
    return ledger.within_tokens(g, ["user_id"], [F.desc("last"), F.desc("n"), F.col("event_type")], "tokens", 400)


@query("""WITH e AS (SELECT event_type, event_id % 2 = 0 AS label, CASE WHEN event_id % 9 <> 0 THEN (event_id * 37 % 101) / 100.0 END AS p, unnest([0.3, 0.5, 0.85]) AS bar FROM events)
SELECT event_type, label, CAST(bar AS DOUBLE) AS bar, count(p) AS n, count(*) FILTER (p >= bar) AS over, count(*) - count(p) AS unscored, CAST(round(median(CAST(p AS DOUBLE)) * 1000) AS BIGINT) AS median_thousandths FROM e GROUP BY 1, 2, 3""")
def calibration_bars(t):
    n = F.col("event_id")
    e = t("events").select("event_type", "event_id", F.when(n % 9 != 0, (n * 37 % 101) / 100.0).alias("p"))
    return ledger.calibration(e, ["event_type"], "p", n % 2 == 0, [0.3, 0.5, 0.85]).withColumn("median_thousandths", F.round(F.col("median") * 1000).cast("long")).drop("median")


@query("""WITH o AS (SELECT user_id, CASE WHEN event_id % 7 <> 0 THEN event_id % 11 END AS k, arg_max(event_type, event_id) AS outcome FROM events WHERE event_id % 3 = 0 GROUP BY 1, 2)
SELECT c.event_id, o.outcome IS NOT NULL AS joined, o.outcome FROM (SELECT event_id, user_id, CASE WHEN event_id % 5 <> 0 THEN event_id % 11 END AS k FROM events WHERE event_id % 3 <> 0) c LEFT JOIN o ON c.user_id = o.user_id AND c.k IS NOT DISTINCT FROM o.k""")
def claim_outcomes(t):
    n, e = F.col("event_id"), t("events")
    c = e.filter("event_id % 3 <> 0").select("event_id", "user_id", F.when(n % 5 != 0, n % 11).alias("k"))
    o = e.filter("event_id % 3 = 0").select("user_id", F.when(n % 7 != 0, n % 11).alias("k"), F.col("event_type").alias("outcome"), n.alias("pos"))
    return ledger.matched_outcomes(c, o, ["user_id", "k"], [F.col("pos")]).select("event_id", "joined", "outcome")


@query("""SELECT p_brand, p_type, CAST(grouping(p_brand) AS BIGINT) * 2 + grouping(p_type) AS of_all, count(DISTINCT p_partkey) AS works, count(*) AS sales, CAST(10000 * count(*) FILTER (l_returnflag = 'R') // count(*) AS BIGINT) AS churn
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ROLLUP (p_brand, p_type)""")
def library_rollup(t):
    rows = t("lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_returnflag").join(t("part").select("p_partkey", "p_brand", "p_type"), "p_partkey")
    # each work is pre-aggregated, so the rollup counts works without a distinct
    works = rows.groupBy("p_partkey", "p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r"))
    return works.rollup("p_brand", "p_type").agg(F.grouping_id().alias("of_all"), F.count(F.lit(1)).alias("works"), F.sum("n").alias("sales"), F.expr("10000 * sum(r) div sum(n)").alias("churn"))


@query("""(SELECT 'order' AS kind, o_orderkey AS id, o_orderdate AS happened FROM orders) UNION ALL (SELECT 'event', event_id, ts FROM events) UNION ALL (SELECT 'shipment', l_orderkey * 8 + l_linenumber, l_shipdate FROM lineitem) ORDER BY happened DESC, kind, id LIMIT 12""")
def recent_runs(t):
    o = t("orders").select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("happened"))
    e = t("events").select(F.lit("event").alias("kind"), F.col("event_id").alias("id"), F.col("ts").alias("happened"))
    s = t("lineitem").select(F.lit("shipment").alias("kind"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), F.col("l_shipdate").alias("happened"))
    return o.unionByName(e).unionByName(s).orderBy(F.desc("happened"), "kind", "id").limit(12)


@query("""WITH h AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (value < 1) AS low FROM events GROUP BY 1)
SELECT hour, n, errors, low, concat_ws('; ', CASE WHEN errors * 5 > n THEN 'errors ' || errors END, CASE WHEN low > 0 THEN 'low ' || low END) AS alert FROM h ORDER BY hour DESC LIMIT 48""")
def alert_history(t):
    h = t("events").groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"), F.count_if(F.col("value") < 1).alias("low"))
    said = F.concat_ws("; ", F.when(F.col("errors") * 5 > F.col("n"), F.concat(F.lit("errors "), F.col("errors").cast("string"))), F.when(F.col("low") > 0, F.concat(F.lit("low "), F.col("low").cast("string"))))
    return h.withColumn("alert", said).orderBy(F.desc("hour")).limit(48)


@query("""SELECT user_id, sha256(string_agg(event_id || ':' || event_type || ':' || coalesce(props, ''), '|' ORDER BY event_id)) AS fingerprint, count(*) AS n FROM events GROUP BY 1""")
def work_fingerprints(t):
    # the rows of one work, which one book bounds
    line = F.concat_ws(":", F.col("event_id").cast("string"), "event_type", F.coalesce("props", F.lit("")))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("event_id", line.alias("x")))), lambda s: s["x"])
    return t("events").groupBy("user_id").agg(F.sha2(F.array_join(rows, "|"), 256).alias("fingerprint"), F.count(F.lit(1)).alias("n"))
