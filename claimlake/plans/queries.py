"""Queries over the given tables, each with DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins, reduce

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    """Registers a function of a table reader under its name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        ORACLE_SQL[f.__name__] = sql
        return f

    return register


def unchecked(f):
    """Registers a function of a table reader for whose rows there is no SQL; tests hold its operator against plain Python."""
    QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
    return f


def cents(c: str):
    return F.round(F.col(c) * 100).cast("long")


CENTS = "CAST(round({0} * 100) AS BIGINT)"


@query(f"SELECT user_id, event_type, count(*) AS n, CAST(sum({CENTS.format('value')}) AS BIGINT) AS cents, max(event_id) AS last_event FROM events GROUP BY ALL")
def claim_rollup(t):
    return t("events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(cents("value")).alias("cents"), F.max("event_id").alias("last_event"))


@query("SELECT event_type, user_id, count(*) AS n, CAST(GROUPING(event_type, user_id) AS BIGINT) AS totalled FROM events GROUP BY GROUPING SETS ((event_type), (user_id), ())")
def report_grouping_sets(t):
    e = t("events")
    return e.groupingSets([["event_type"], ["user_id"], []], "event_type", "user_id").agg(F.count(F.lit(1)).alias("n"), F.grouping_id("event_type", "user_id").alias("totalled"))


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def first_occurrence(t):
    return reduce.first_wins(t("events"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("event_id", "user_id", "event_type")


@query("""WITH s AS (SELECT user_id, min(CASE WHEN event_type = 'purchase' THEN event_id END) AS settled_at FROM events GROUP BY 1)
SELECT e.user_id, any_value(settled_at) AS settled_at, arg_max(value, event_id) AS last_value, count(*) AS n_before
FROM events e JOIN s USING (user_id) WHERE settled_at IS NULL OR event_id <= settled_at GROUP BY 1""")
def freeze_rule(t):
    return reduce.frozen(t("events"), ["user_id"], "event_id", F.col("event_type") == "purchase", "value")


@query("SELECT user_id, count(*) FILTER (last <> event_type) AS n_flips, count(*) AS n_rows FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS last FROM events) GROUP BY 1")
def verdict_flips(t):
    return reduce.flips(t("events"), ["user_id"], "event_id", "event_type")


@query("""WITH m AS (SELECT *, coalesce(CAST(lag(event_type) OVER w <> event_type AS INT), 1) AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
i AS (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS island FROM m)
SELECT user_id, island, any_value(event_type) AS event_type, min(event_id) AS first_seq, max(event_id) AS last_seq, count(*) AS n_rows FROM i GROUP BY 1, 2""")
def stage_runs(t):
    return reduce.runs(t("events"), ["user_id"], "event_id", "event_type")


@query("""SELECT o_orderkey, o_orderpriority, CAST(sum(round(o_totalprice * 100)) OVER w AS BIGINT) AS running, sum(round(o_totalprice * 100)) OVER w <= 100000000 AS granted
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey ROWS UNBOUNDED PRECEDING)""")
def budget_admission(t):
    o = t("orders").withColumn("cents", cents("o_totalprice"))
    return reduce.admitted(o, "o_custkey", ["o_orderpriority", "o_orderkey"], "cents", 100_000_000).select("o_orderkey", "o_orderpriority", "running", "granted")


@query("""WITH g AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS g FROM events),
p AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY g, value DESC, event_id) AS INT) AS pick FROM g)
SELECT user_id, event_id, event_type, pick FROM p WHERE pick <= 3""")
def distinct_preferred_top3(t):
    return reduce.spread_top(t("events"), ["user_id"], "event_type", [F.desc("value"), F.col("event_id")], 3).select("user_id", "event_id", "event_type", "pick")


@query("""SELECT CAST(t AS DOUBLE) AS threshold, count(*) FILTER (s >= t AND y = 1) AS tp, count(*) FILTER (s >= t AND y = 0) AS fp, count(*) FILTER (s < t AND y = 0) AS tn, count(*) FILTER (s < t AND y = 1) AS fn
FROM (SELECT least(1, n_chars / 4000.0) AS s, quality AS y FROM documents JOIN labels USING (doc_id)), (VALUES (0.5), (0.85)) AS v(t) GROUP BY t""")
def score_confusion(t):
    scored = t("documents").join(t("labels"), "doc_id").select(F.least(F.lit(1.0), F.col("n_chars") / 4000.0).alias("s"), "quality")
    return reduce.confusion(scored, "s", F.col("quality") == 1, [0.5, 0.85])


@query("""SELECT c.event_id, c.user_id, max(p.event_id) AS before_src FROM events c LEFT JOIN events p ON p.user_id = c.user_id AND p.event_type = 'view' AND p.event_id <= c.event_id
WHERE c.event_type = 'click' GROUP BY 1, 2""")
def referent_as_of(t):
    e = t("events")
    views = e.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("at"), F.col("event_id").alias("src"))
    clicks = e.filter("event_type = 'click'").select("event_id", "user_id", F.col("event_id").alias("at"))
    return joins.nearest_before(clicks, views, "user_id", "at", "src").select("event_id", "user_id", "before_src")


@query("""SELECT o_orderkey, CASE WHEN l_orderkey IS NULL THEN o_orderstatus ELSE 'R' END AS status FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') ON o_orderkey = l_orderkey
UNION ALL SELECT DISTINCT l_orderkey, 'R' FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def store_upsert(t):
    new = t("lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), F.lit("R").alias("status")).distinct()
    return joins.upsert(t("orders").select("o_orderkey", F.col("o_orderstatus").alias("status")), new, ["o_orderkey"])


@query("""SELECT doc_id, 'label' AS origin FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, 'document' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def store_insert_missing(t):
    return joins.insert_missing(t("labels").filter("quality = 1").select("doc_id", F.lit("label").alias("origin")), t("documents").select("doc_id", F.lit("document").alias("origin")), ["doc_id"])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def orphan_cleanup(t):
    return joins.without_orphans(t("customer").select("c_custkey", "c_name"), "c_custkey", [t("orders").select(F.col("o_custkey").alias("c_custkey"))])


@query("""WITH a AS (SELECT DISTINCT user_id * 24 + hour(ts) AS k FROM events WHERE ts < TIMESTAMP '2024-01-16'), b AS (SELECT DISTINCT user_id * 24 + hour(ts) AS k FROM events WHERE ts >= TIMESTAMP '2024-01-16')
SELECT coalesce(a.k, b.k) AS user_hour, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'shared' END AS state FROM a FULL JOIN b ON a.k = b.k""")
def run_comparison(t):
    e = t("events").withColumn("user_hour", F.col("user_id") * 24 + F.hour("ts"))
    return joins.compared(e.filter("ts < timestamp_ntz'2024-01-16'"), e.filter("ts >= timestamp_ntz'2024-01-16'"), "user_hour")


@query("""SELECT md5(text) AS text_hash, count(*) AS n, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1""")
def duplicate_texts(t):
    d = t("documents").groupBy(F.md5("text").alias("text_hash")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"))
    return d.filter("n > 1")


@query("""SELECT source, count(*) AS n_docs, count(l.doc_id) AS n_labelled, CAST(10000 * count(l.doc_id) // count(*) AS BIGINT) AS coverage FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def label_coverage(t):
    d = t("documents").join(t("labels").select("doc_id", F.lit(1).alias("y")), "doc_id", "left")
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.count("y").alias("n_labelled"), F.expr("10000 * count(y) div count(1)").alias("coverage"))


@query("""SELECT doc_id, CAST(i AS INT) AS chunk, CAST(length(substr(text, CAST(8000 * i + 1 AS BIGINT), 8000)) AS BIGINT) AS n_chars, md5(substr(text, CAST(8000 * i + 1 AS BIGINT), 8000)) AS chunk_hash
FROM (SELECT doc_id, text, unnest(range(0, (length(text) + 7999) // 8000)) AS i FROM documents WHERE length(text) > 0)""")
def fixed_chunks(t):
    d = t("documents").filter(F.length("text") > 0).select("doc_id", "text", F.explode(F.expr("sequence(0, cast((length(text) + 7999) div 8000 - 1 as int))")).alias("chunk"))
    piece = F.substring("text", F.col("chunk") * 8000 + 1, F.lit(8000))
    return d.select("doc_id", "chunk", F.length(piece).cast("long").alias("n_chars"), F.md5(piece).alias("chunk_hash"))


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k FROM events WHERE json_valid(props) GROUP BY 1")
def event_payloads(t):
    return t("events").select("event_type", F.from_json("props", "k long").alias("p")).filter("p IS NOT NULL").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("p.k").alias("sum_k"))
