"""Rulings, harvest counters and reconciliations over the given tables. Each query has DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import evidence
from ..operators import desk, metrics
from .claims import WINDOWS
from .queries import query

_VERBS = """v AS (SELECT user_id AS work, 'N' || (event_id % 9) AS name, CASE event_type WHEN 'view' THEN 'approve' WHEN 'click' THEN 'approve' WHEN 'purchase' THEN 'unapprove' WHEN 'signup' THEN 'unapprove' ELSE 'look' END AS verb, event_id AS at_ FROM events),
k AS (SELECT DISTINCT user_id AS work, 'N' || (event_id % 9) AS name FROM events WHERE event_type = 'view' AND event_id % 9 < 7),
j AS (SELECT v.*, k.name IS NOT NULL AS known, last_value(CASE WHEN verb = 'approve' AND k.name IS NOT NULL THEN TRUE WHEN verb = 'unapprove' THEN FALSE END IGNORE NULLS) OVER (PARTITION BY v.work, v.name ORDER BY at_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stands FROM v LEFT JOIN k ON v.work = k.work AND v.name = k.name),
r AS (SELECT *, CASE verb WHEN 'approve' THEN CASE WHEN NOT known THEN 'not a stored person' END WHEN 'unapprove' THEN CASE WHEN NOT coalesce(stands, FALSE) THEN 'nothing to remove' END ELSE 'unknown verb' END AS refusal FROM j)"""


def _verbs(t):
    verb = F.when(F.col("event_type").isin("view", "click"), "approve").when(F.col("event_type").isin("purchase", "signup"), "unapprove").otherwise("look")
    name = F.concat(F.lit("N"), (F.col("event_id") % 9).cast("string"))
    verbs = t("events").select(F.col("user_id").alias("work"), name.alias("name"), verb.alias("verb"), F.col("event_id").alias("at"), F.lit(0).alias("seq"))
    people = t("events").filter("event_type = 'view' AND event_id % 9 < 7").select(F.col("user_id").alias("work"), name.alias("name"))
    return desk.push_ledger(verbs, people)


@query(f"WITH {_VERBS} SELECT work, name, at_ AS \"at\", refusal IS NULL AS accepted, refusal FROM r")
def ledger_verbs(t):
    return _verbs(t).select("work", "name", "at", "accepted", "refusal")


@query(f"WITH {_VERBS}, l AS (SELECT work, name, max(at_) AS at_, arg_max(verb, at_) AS verb FROM r WHERE refusal IS NULL GROUP BY 1, 2) SELECT work, name, at_ AS \"at\" FROM l WHERE verb = 'approve'")
def ledger_standing(t):
    return desk.standing(_verbs(t).drop("close"), ["work", "name"], ["at", "seq"], "verb", "approve").select("work", "name", "at")


@query("""WITH v AS (SELECT trim(p_type) AS type, p_partkey AS at_, CASE WHEN p_partkey % 3 = 0 THEN 'unreject' ELSE 'reject' END AS verb, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_name END AS reason FROM part),
j AS (SELECT *, last_value(CASE WHEN verb = 'unreject' THEN FALSE WHEN reason <> '' THEN TRUE END IGNORE NULLS) OVER (PARTITION BY type ORDER BY at_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stands FROM v),
l AS (SELECT type, arg_max(verb, at_) AS verb, arg_max(reason, at_) AS reason FROM j WHERE CASE verb WHEN 'reject' THEN reason <> '' ELSE coalesce(stands, FALSE) END GROUP BY 1)
SELECT p_partkey, l.reason AS rejected_reason FROM part LEFT JOIN l ON l.type = p_type AND l.verb = 'reject'""")
def annotated_proposals(t):
    p = t("part")
    verbs = p.select(F.concat(F.lit(" "), "p_type").alias("type"), F.when(F.col("p_partkey") % 3 == 0, "unreject").otherwise("reject").alias("verb"), F.when(F.col("p_partkey") % 5 == 0, " ").otherwise(F.col("p_name")).alias("reason"), F.col("p_partkey").alias("at"), F.lit(0).alias("seq"))
    rejected = desk.standing(desk.rejected_types(verbs), ["type"], ["at", "seq"], "verb", "reject")
    return desk.annotated(p.select("p_partkey", "p_type"), rejected, "p_type").select("p_partkey", "rejected_reason")


@query("""WITH c AS (SELECT user_id AS work, CASE WHEN event_id % 3 = 0 THEN 'dropped' WHEN event_id % 4 = 0 THEN 'downgraded' ELSE 'shipped' END AS d, event_id % 9 <> 0 AS judged, event_id % 7 <> 0 AS w FROM events WHERE event_type <> 'error'),
q AS (SELECT user_id AS work, CASE event_id % 4 WHEN 0 THEN 'decision' WHEN 1 THEN 'fallback' WHEN 2 THEN 'retrieval' END AS gate, event_id % 5 <> 0 AS judged FROM events WHERE event_type = 'error'),
a AS (SELECT work, count(*) AS records, count(*) FILTER (judged) AS draws, count(*) FILTER (d = 'shipped') AS shipped, count(*) FILTER (d = 'downgraded') AS downgraded, count(*) FILTER (d = 'dropped') AS dropped, count(*) FILTER (w) AS windows, count(*) FILTER (NOT w) AS windows_empty FROM c GROUP BY 1),
b AS (SELECT work, count(*) FILTER (gate = 'decision' AND judged) AS decisions, count(*) FILTER (gate = 'fallback') AS left_out_fallback, count(*) FILTER (gate IS NULL OR gate = 'retrieval' OR gate = 'decision' AND NOT judged) AS left_out_unjudged FROM q GROUP BY 1)
SELECT coalesce(a.work, b.work) AS work, coalesce(records, 0) AS records, coalesce(draws, 0) AS draws, coalesce(shipped, 0) AS shipped, coalesce(downgraded, 0) AS downgraded, coalesce(dropped, 0) AS dropped, coalesce(windows, 0) AS windows, coalesce(windows_empty, 0) AS windows_empty,
coalesce(decisions, 0) AS decisions, coalesce(left_out_fallback, 0) AS left_out_fallback, coalesce(left_out_unjudged, 0) AS left_out_unjudged FROM a FULL JOIN b ON a.work = b.work""")
def judge_counters(t):
    e, n = t("events").withColumnRenamed("user_id", "work"), F.col("event_id")
    done = F.when(n % 3 == 0, "dropped").when(n % 4 == 0, "downgraded").otherwise("shipped")
    claims = e.filter("event_type <> 'error'").select("work", (n % 3 != 0).alias("shipped"), done.alias("disposition"), F.when(n % 9 != 0, F.lit(0.5)).alias("p"), F.when(n % 7 != 0, "w").alias("window"))
    gate = F.when(n % 4 == 0, "decision").when(n % 4 == 1, "fallback").when(n % 4 == 2, "retrieval")
    return desk.judge_counters(claims, e.filter("event_type = 'error'").select("work", gate.alias("gate"), F.when(n % 5 != 0, F.lit(0.5)).alias("p")))


@query("""SELECT 'uncertainty_queue' AS source, CAST(doc_id AS VARCHAR) AS item, CASE quality WHEN 1 THEN 'yes' ELSE 'no' END AS verdict, 'someone' AS labeller, CASE WHEN doc_id % 2 = 0 THEN 'day ' || doc_id END AS decided_at FROM labels WHERE doc_id % 3 <> 0
UNION ALL SELECT 'remote:orders', CAST(o_orderkey AS VARCHAR), CASE o_orderstatus WHEN 'F' THEN 'confirmed' ELSE 'rejected' END, NULL, CASE WHEN o_orderkey % 2 = 0 THEN 'decided' WHEN o_orderkey % 3 = 0 THEN 'labelled' END FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def gold_rulings(t):
    lab = t("labels").select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 3 != 0, F.when(F.col("quality") == 1, "yes").otherwise("no")).alias("label"), F.lit("someone").alias("labelled_by"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("day "), F.col("doc_id").cast("string"))).alias("labelled_at"))
    n = F.col("o_orderkey")
    rows = t("orders").select(n.alias("id"), F.when(F.col("o_orderstatus") == "F", "confirmed").when(F.col("o_orderstatus") == "O", "rejected").otherwise("pending").alias("status"), F.when(n % 2 == 0, "decided").alias("decided_at"), F.lit(None).cast("string").alias("reviewed_at"), F.when(n % 3 == 0, "labelled").alias("labelled_at"))
    return desk.gold(lab, {"orders": rows})


@query("""WITH a AS (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_linenumber < 3 GROUP BY 1), b AS (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_linenumber < 3 AND (l_suppkey % 2 = 0 OR l_discount > 0.05) GROUP BY 1)
SELECT l_suppkey, coalesce(a.n, 0) AS in_artefacts, coalesce(b.n, 0) AS harvested, CASE WHEN coalesce(a.n, 0) = coalesce(b.n, 0) THEN 'PASS' ELSE 'FAIL' END AS verdict FROM a FULL JOIN b USING (l_suppkey)""")
def harvest_reconciliation(t):
    rows = t("lineitem").filter("l_linenumber < 3")

    def counted(df):
        return df.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))

    return desk.reconciled(counted(rows), counted(rows.filter("l_suppkey % 2 = 0 OR l_discount > 0.05")), ["l_suppkey"])


@query("""WITH s AS (SELECT DISTINCT user_id, event_id % 7 AS name FROM events WHERE event_type = 'view'), m AS (SELECT DISTINCT user_id, event_id % 9 AS name FROM events WHERE event_type = 'click'), p AS (SELECT DISTINCT user_id, event_id % 8 AS name FROM events WHERE event_type <> 'error'),
o AS (SELECT * FROM s UNION SELECT * FROM m), w AS (SELECT user_id FROM o UNION SELECT user_id FROM p),
r AS (SELECT user_id, (SELECT count(*) FROM s WHERE s.user_id = w.user_id) AS stored, (SELECT count(*) FROM m WHERE m.user_id = w.user_id) AS minors, (SELECT count(*) FROM p WHERE p.user_id = w.user_id) AS roster,
(SELECT count(*) FROM (SELECT * FROM p EXCEPT SELECT * FROM o) x WHERE x.user_id = w.user_id) AS missing, (SELECT count(*) FROM (SELECT * FROM o EXCEPT SELECT * FROM p) x WHERE x.user_id = w.user_id) AS extra FROM w) SELECT *, CASE WHEN missing + extra = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM r""")
def roster_reports(t):
    e = t("events")

    def named(kind, k):
        return e.filter(kind).select("user_id", (F.col("event_id") % k).alias("name"))

    return desk.roster_report(named("event_type = 'view'", 7), named("event_type = 'click'", 9), named("event_type <> 'error'", 8), "user_id")


@query(f"""WITH {WINDOWS} SELECT d.doc_id AS pos, CASE WHEN d.doc_id % 4 <> 0 THEN d.doc_id END AS chapter_index, CASE WHEN d.doc_id % 3 = 0 THEN 'dropped' WHEN d.doc_id % 5 = 0 OR d.doc_id % 7 = 0 THEN 'downgraded' ELSE 'shipped' END AS disposition, d.doc_id % 2 = 0 AS judged, coalesce(x.window_hash, md5('')) AS window_hash
FROM documents d LEFT JOIN x ON d.doc_id = x.doc_id AND d.doc_id % 4 <> 0""")
def judge_records(t):
    """Each document's fourth sentence as the quote of a claim whose chapter is the document."""
    d, n = t("documents"), F.col("doc_id")
    label = F.when(n % 4 != 0, F.concat(F.lit("d"), n.cast("string"))).otherwise("unknown")
    claims = d.select(F.col("source").alias("work"), n.alias("pos"), (n % 3 != 0).alias("shipped"), F.lit("a").alias("from"), F.lit("b").alias("to"), F.lit("ally").alias("type"), F.when(n % 5 == 0, "parent").alias("original_type"), F.when(n % 7 == 0, " Downgraded ").alias("note"), F.when(n % 2 == 0, F.lit(0.5)).alias("p"), label.alias("chapter"), F.get(evidence.sentences("text"), F.lit(3)).alias("quote"))
    labels = d.select(F.col("source").alias("work"), n.alias("pos"), F.concat(F.lit("d"), n.cast("string")).alias("label"), n.alias("index"))
    texts = d.select(F.col("source").alias("work"), n.alias("index"), "text")
    return desk.judge_records(claims, labels, texts).select("pos", "chapter_index", "disposition", "judged", F.md5("window").alias("window_hash"))


@query("""WITH c AS (SELECT event_type, CASE event_id % 3 WHEN 0 THEN 'supports' WHEN 1 THEN 'adjacent' ELSE 'contradicts' END AS expected, CASE event_id % 5 WHEN 0 THEN 'supports' WHEN 1 THEN 'adjacent' WHEN 2 THEN 'contradicts' WHEN 3 THEN 'other' END AS got FROM events)
SELECT event_type, expected, count(*) FILTER (got = 'supports') AS supports, count(*) FILTER (got = 'adjacent') AS adjacent, count(*) FILTER (got = 'contradicts') AS contradicts, count(*) FILTER (got IS NULL OR got = 'other') AS no_verdict, count(*) AS n, count(*) FILTER (got = expected) AS correct,
count(*) FILTER (got = expected) / count(*) AS accuracy, CASE WHEN expected = 'adjacent' THEN count(*) FILTER (got = 'supports') / count(*) END AS leakage FROM c GROUP BY 1, 2""")
def passage_confusion(t):
    n = F.col("event_id")
    x = t("events").withColumn("expected", F.when(n % 3 == 0, "supports").when(n % 3 == 1, "adjacent").otherwise("contradicts")).withColumn("got", F.when(n % 5 == 0, "supports").when(n % 5 == 1, "adjacent").when(n % 5 == 2, "contradicts").when(n % 5 == 3, "other"))
    return metrics.class_confusion(x, ["event_type"], "expected", "got")


@query("""WITH c AS (SELECT user_id, CASE event_type WHEN 'view' THEN 'yes' WHEN 'click' THEN 'no' WHEN 'error' THEN NULL ELSE 'ambiguous' END AS v, CASE WHEN event_id % 7 <> 0 THEN event_id % 2 = 0 END AS y FROM events),
x AS (SELECT user_id, count(*) FILTER (v = 'yes' AND y) AS tp, count(*) FILTER (v = 'yes' AND NOT y) AS fp, count(*) FILTER (v = 'no' AND NOT y) AS tn, count(*) FILTER (v = 'no' AND y) AS fn, count(*) FILTER (v IS NULL OR v = 'ambiguous') AS ambiguous, count(*) AS n FROM c WHERE y IS NOT NULL GROUP BY 1)
SELECT user_id, tp, fp, tn, fn, ambiguous, (tp + fp + tn + fn) / n AS decided_share, ambiguous / n AS ambiguous_share, CASE WHEN tp + fp + tn + fn > 0 THEN (tp + tn) / (tp + fp + tn + fn) ELSE 0 END AS accuracy FROM x""")
def tier_accuracy(t):
    verdict = F.when(F.col("event_type") == "view", "yes").when(F.col("event_type") == "click", "no").when(F.col("event_type") != "error", "ambiguous")
    same = F.when(F.col("event_id") % 7 != 0, F.col("event_id") % 2 == 0)
    return metrics.decided_tiers(t("events").withColumn("v", verdict), ["user_id"], "v", same)


_STATE = "CASE o_orderkey % 5 WHEN 0 THEN 'shipped' WHEN 1 THEN 'staged' WHEN 2 THEN 'dropped' WHEN 3 THEN 'absent' ELSE 'no-preview' END"


@query(f"""WITH c AS (SELECT o_orderpriority, CASE o_orderstatus WHEN 'F' THEN 'CONFIRM' ELSE 'REJECT' END AS v, {_STATE} AS s, o_custkey % 2 = 0 AS rule, o_custkey % 3 = 0 AS only_ FROM orders)
SELECT o_orderpriority, count(*) FILTER (rule AND v = 'REJECT' AND s = 'shipped') AS rejects_shipped, count(*) FILTER (rule AND v = 'CONFIRM' AND s <> 'no-preview') AS confirms, count(*) FILTER (v = 'REJECT' AND s IN ('shipped', 'staged', 'dropped')) AS regenerated, count(*) FILTER (only_) AS interpretation_only,
count(*) FILTER (only_ AND v = 'REJECT' AND s = 'shipped') AS interpretation_rejects, count(*) FILTER (s = 'shipped') AS shipped, count(*) FILTER (s = 'staged') AS staged, count(*) FILTER (s = 'dropped') AS dropped, count(*) FILTER (s = 'absent') AS absent, count(*) FILTER (s = 'no-preview') AS no_preview,
CASE WHEN count(*) FILTER (rule AND v = 'CONFIRM' AND s <> 'no-preview') > 0 THEN count(*) FILTER (rule AND v = 'CONFIRM' AND s = 'shipped') / count(*) FILTER (rule AND v = 'CONFIRM' AND s <> 'no-preview') END AS retention FROM c GROUP BY 1""")
def review_headline(t):
    o = t("orders").withColumn("v", F.when(F.col("o_orderstatus") == "F", "CONFIRM").otherwise("REJECT")).withColumn("s", F.expr(_STATE))
    return metrics.fixture_headline(o, ["o_orderpriority"], "v", "s", F.col("o_custkey") % 2 == 0, F.col("o_custkey") % 3 == 0)


@query("""WITH c AS (SELECT user_id, event_id % 2 = 0 AS label, CASE event_type WHEN 'view' THEN 'kept' WHEN 'click' THEN 'downgraded' WHEN 'purchase' THEN 'wrong_type' WHEN 'signup' THEN 'dropped' END AS o FROM events)
SELECT user_id, label, count(*) FILTER (o = 'kept') AS kept, count(*) FILTER (o = 'downgraded') AS downgraded, count(*) FILTER (o = 'wrong_type') AS wrong_type, count(*) FILTER (o = 'dropped') AS dropped, count(*) FILTER (o IS NULL) AS absent FROM c GROUP BY 1, 2""")
def pair_outcomes(t):
    kind = F.col("event_type")
    out = F.when(kind == "view", "kept").when(kind == "click", "downgraded").when(kind == "purchase", "wrong_type").when(kind == "signup", "dropped")
    return metrics.labelled_outcomes(t("events").withColumn("o", out), ["user_id"], F.col("event_id") % 2 == 0, "o")


@query("SELECT user_id, chapter, CAST(row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN regexp_full_match(chapter, '[0-9]+') THEN 0 ELSE 1 END, CASE WHEN regexp_full_match(chapter, '[0-9]+') THEN CAST(chapter AS BIGINT) ELSE 0 END, chapter) AS INT) AS place FROM (SELECT DISTINCT user_id, CASE WHEN event_id % 3 = 0 THEN 'x' || (event_id % 20) ELSE CAST(event_id % 200 AS VARCHAR) END AS chapter FROM events)")
def chapters_in_order(t):
    from pyspark.sql import Window

    from ..functions import names

    n = F.col("event_id")
    c = t("events").select("user_id", F.when(n % 3 == 0, F.concat(F.lit("x"), (n % 20).cast("string"))).otherwise((n % 200).cast("string")).alias("chapter")).distinct()
    return c.withColumn("place", F.row_number().over(Window.partitionBy("user_id").orderBy(names.chapter_order("chapter"))))
