"""What chapters say of books, which claims pass the gates, and who is one person; each with DuckDB SQL for the same rows.

Events stand for observations: a user is a book, a day a chapter, an event_type a label.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chapters, clusters, gates
from ..streaming import windows
from .queries import query

_SEEN = "o AS (SELECT user_id, day(ts) AS chapter, event_type, event_id, ['none', 'mentioned', 'on_page', 'graphic'][CAST(event_id * 7 % 4 + 1 AS INT)] AS severity, event_id * 7 % 4 AS claimed, event_id % 3 = 0 AS proof, event_id % 8 <> 0 AS ok FROM events)"
_COVER = "c AS (SELECT user_id, count(*) AS chapters_total, count(*) FILTER (ok) AS chapters_successful FROM (SELECT user_id, chapter, bool_or(ok) AS ok FROM o GROUP BY 1, 2) GROUP BY 1)"


def _seen(t):
    n = F.col("event_id")
    severity = F.element_at(F.array(*map(F.lit, chapters.SEVERITIES)), (n * 7 % 4 + 1).cast("int"))
    return t("events").select("user_id", F.dayofmonth("ts").cast("long").alias("chapter"), "event_type", "event_id", severity.alias("severity"), (n % 3 == 0).alias("proof"), (n % 8 != 0).alias("ok"))


def _cover(t):
    return chapters.coverage(_seen(t), ["user_id"], "chapter", F.col("ok"))


@query(f"WITH {_SEEN}, {_COVER} SELECT *, chapters_successful * 2 < chapters_total AS coverage_warning FROM c")
def chapter_coverage(t):
    return _cover(t)


@query(f"""WITH {_SEEN}, {_COVER}, g AS (SELECT user_id, event_type, max(CASE WHEN proof THEN claimed ELSE least(claimed, 1) END) AS r, max(claimed) AS cl, list_sort(list(DISTINCT chapter)) AS ch FROM o WHERE claimed > 0 GROUP BY 1, 2),
k AS (SELECT g.*, len(ch) AS n, CASE WHEN chapters_successful > 0 THEN len(ch) / chapters_successful ELSE 0 END AS f FROM g JOIN c USING (user_id) WHERE r > 1 OR len(ch) > 1),
s AS (SELECT *, ['none', 'mentioned', 'on_page', 'graphic'][CAST(r + 1 AS INT)] AS severity, ['none', 'mentioned', 'on_page', 'graphic'][CAST(cl + 1 AS INT)] AS severity_claimed FROM k)
SELECT user_id, event_type, severity, severity_claimed, array_to_string(ch, ',') AS chapters, CAST(n AS BIGINT) AS chapter_count,
CASE WHEN f <= 0 THEN 'low' WHEN severity = 'graphic' AND f >= 0.06 OR severity = 'on_page' AND f >= 0.15 THEN 'high' WHEN severity = 'graphic' OR severity = 'on_page' AND f >= 0.06 OR severity = 'mentioned' AND f >= 0.15 THEN 'medium' ELSE 'low' END AS prominence FROM s""")
def content_warnings(t):
    return chapters.warnings(_seen(t), ["user_id"], "event_type", "chapter", "severity", F.col("proof"), _cover(t)).withColumn("chapters", F.array_join("chapters", ","))


@query("""WITH x AS (SELECT l_suppkey, greatest(0, least(5, CAST(l_quantity AS INT) % 9 - 2)) AS x FROM lineitem),
g AS (SELECT l_suppkey, max(x) AS peak, count(*) AS chapters, count(*) FILTER (x >= 1) AS n1, count(*) FILTER (x >= 2) AS n2, count(*) FILTER (x >= 4) AS n3 FROM x GROUP BY 1),
b AS (SELECT *, CASE WHEN peak <= 0 THEN 0 WHEN peak <= 1 THEN 1 WHEN peak <= 3 THEN 2 ELSE 3 END AS band FROM g), f AS (SELECT *, CASE band WHEN 1 THEN n1 WHEN 2 THEN n2 WHEN 3 THEN n3 ELSE 0 END AS n FROM b),
s AS (SELECT *, CASE WHEN n / chapters < 0.06 THEN 1 WHEN n / chapters < 0.15 THEN 2 WHEN n / chapters < 0.35 THEN 3 ELSE 4 END AS o FROM f)
SELECT l_suppkey, CAST(peak AS INT) AS peak, chapters, CAST(n AS BIGINT) AS at_peak, CAST(CASE WHEN band = 0 THEN 0 ELSE ([[1, 1, 2, 2], [1, 2, 3, 4], [2, 3, 4, 5]][band])[o] END AS INT) AS level FROM s""")
def spice_levels(t):
    return chapters.intensity(t("lineitem").select("l_suppkey", (F.col("l_quantity").cast("int") % 9 - 2).alias("peak")), ["l_suppkey"], "peak")


@query("""WITH e AS (SELECT DISTINCT user_id, day(ts) AS chapter, CASE WHEN event_type <> 'error' THEN event_type END AS who FROM events), n AS (SELECT user_id, count(DISTINCT chapter) AS total FROM e GROUP BY 1)
SELECT user_id, who, count(*) AS chapter_count FROM e JOIN n USING (user_id) WHERE who IS NOT NULL GROUP BY 1, 2, total HAVING count(*) >= CASE WHEN total < 4 THEN 1 ELSE 2 END""")
def told_by(t):
    e = t("events").select("user_id", F.dayofmonth("ts").alias("chapter"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("who"))
    return chapters.points_of_view(e, ["user_id"], "chapter", "who")


@query("""WITH e AS (SELECT o_custkey % 50 AS book, o_orderdate AS chapter, o_custkey AS label FROM orders), n AS (SELECT book, greatest(3, count(DISTINCT chapter) // 20) AS least FROM e GROUP BY 1),
c AS (SELECT book, label, count(DISTINCT chapter) AS k FROM e GROUP BY 1, 2), g AS (SELECT book, count(*) AS labels, count(*) FILTER (k < least) AS below FROM c JOIN n USING (book) GROUP BY 1)
SELECT *, CAST(round_even(100 * below / labels, 0) AS BIGINT) AS percent FROM g""")
def gated_labels(t):
    return chapters.gated(t("orders").select((F.col("o_custkey") % 50).alias("book"), F.col("o_orderdate").alias("chapter"), F.col("o_custkey").alias("label")), ["book"], "label", "chapter")


@query("""WITH e AS (SELECT l_suppkey, min(l_quantity / 4) AS lo, max(l_quantity / 4) AS hi FROM lineitem GROUP BY 1)
SELECT l_suppkey, unnest(range(CAST(floor(lo) AS BIGINT) + 1, CAST(floor(hi) AS BIGINT) + 1)) AS crossed FROM e""")
def level_crossings(t):
    return chapters.crossings(t("lineitem").select("l_suppkey", (F.col("l_quantity") / 4).alias("level")), ["l_suppkey"], "level")


_STAGED = """r AS (SELECT p_brand, l_partkey, year(l_shipdate) * 12 + month(l_shipdate) AS run, l_linenumber <> 1 AS own, CASE WHEN l_discount >= 0.09 THEN 'evidence' WHEN l_quantity >= 48 THEN 'support' END AS firm FROM lineitem JOIN part ON l_partkey = p_partkey),
d AS (SELECT p_brand, run, row_number() OVER (PARTITION BY p_brand ORDER BY run) AS pos, count(*) OVER (PARTITION BY p_brand) AS done FROM (SELECT DISTINCT p_brand, run FROM r WHERE own)),
s AS (SELECT p_brand, l_partkey, run, max(firm) AS firm FROM r WHERE own GROUP BY 1, 2, 3),
n AS (SELECT s.*, pos, done, lead(pos) OVER w - pos AS gap, lead(firm) OVER w AS upon, count(*) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n, max(s.run) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS last
  FROM s JOIN d ON d.p_brand = s.p_brand AND d.run = s.run WINDOW w AS (PARTITION BY s.p_brand, l_partkey ORDER BY pos)),
u AS (SELECT *, firm IS NULL AND coalesce(gap <= 3, FALSE) AS up FROM n), f AS (SELECT *, min(CASE WHEN up THEN pos END) OVER (PARTITION BY p_brand, l_partkey) AS first FROM u),
g AS (SELECT p_brand, l_partkey, CAST(run AS INT) AS first_run, CAST(CASE WHEN up THEN last ELSE run END AS INT) AS last_run, CASE WHEN up THEN n ELSE 1 END AS sightings,
  CASE WHEN up THEN 'promoted' WHEN coalesce(gap > 3, done - pos >= 3) THEN 'expired' ELSE 'staged' END AS state, CASE WHEN up THEN coalesce(upon, 'persistence') END AS via
  FROM f WHERE firm IS NULL AND (first IS NULL OR pos <= first))"""


def _staged(t):
    r = t("lineitem").join(t("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey").withColumn("run", F.year("l_shipdate") * 12 + F.month("l_shipdate"))
    firm = F.when(F.col("l_discount") >= 0.09, "evidence").when(F.col("l_quantity") >= 48, "support")
    return gates.staged(r, ["p_brand", "l_partkey"], "p_brand", "run", F.col("l_linenumber") != 1, firm)


@query(f"WITH {_STAGED} SELECT * FROM g")
def staging_gate(t):
    return _staged(t)


@query(f"""WITH {_STAGED}, c AS (SELECT p_brand, sum(p_size) AS staged_ever FROM part GROUP BY 1), k AS (SELECT p_brand, count(*) FILTER (state = 'staged') AS staged, count(*) FILTER (state = 'promoted') AS promoted, count(*) FILTER (state = 'expired') AS expired FROM g GROUP BY 1)
SELECT p_brand, CAST(staged_ever AS BIGINT) AS staged_ever, coalesce(staged, 0) AS staged, coalesce(promoted, 0) AS promoted, coalesce(expired, 0) AS expired, CAST(staged_ever - coalesce(staged, 0) - coalesce(promoted, 0) - coalesce(expired, 0) AS BIGINT) AS unaccounted FROM c LEFT JOIN k USING (p_brand)""")
def staging_account(t):
    # the counter that the store kept: here, the sizes of a brand's parts
    return gates.staging_account(_staged(t), t("part").select("p_brand", F.col("p_size").cast("long").alias("n")), ["p_brand"], "n")


@query("SELECT user_id, count(*) AS attempts, count(*) FILTER (event_type = 'error') AS errors, count(*) >= 8 AND count(*) FILTER (event_type = 'error') >= 0.25 * count(*) AS tripped FROM events GROUP BY 1")
def circuit_breakers(t):
    return gates.breakers(t("events"), ["user_id"], F.col("event_type") == "error", rate=0.25, least=8)


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS demand, CAST(length(event_type) AS BIGINT) AS reserve, CAST(60 AS BIGINT) AS budget FROM events GROUP BY 1, 2),
x AS (SELECT *, sum(demand) OVER w AS d, greatest(0, budget - coalesce(sum(reserve) OVER (PARTITION BY user_id ORDER BY event_type ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)) AS cap FROM c WINDOW w AS (PARTITION BY user_id ORDER BY event_type)),
y AS (SELECT *, d + least(0, min(cap - d) OVER w) AS s FROM x WINDOW w AS (PARTITION BY user_id ORDER BY event_type)), z AS (SELECT *, s - coalesce(lag(s) OVER (PARTITION BY user_id ORDER BY event_type), 0) AS g FROM y)
SELECT user_id, event_type, demand, reserve, budget, CAST(g AS BIGINT) AS granted, CAST(demand - g AS BIGINT) AS denied FROM z""")
def budget_reserves(t):
    c = t("events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("demand")).withColumn("reserve", F.length("event_type").cast("long")).withColumn("budget", F.lit(60).cast("long"))
    return gates.reserved(c, "user_id", "event_type", "demand", "reserve", "budget")


@query("""WITH r AS (SELECT o_custkey, o_orderkey, CAST(floor(pow(o_totalprice / 50000, 4)) AS BIGINT) AS readers FROM orders),
w AS (SELECT *, row_number() OVER q AS i, lead(readers) OVER q AS runner_up FROM r WINDOW q AS (PARTITION BY o_custkey ORDER BY readers DESC, o_orderkey))
SELECT o_custkey, o_orderkey, readers, runner_up IS NOT NULL AS dominance FROM w WHERE i = 1 AND (runner_up IS NULL OR readers >= 100 AND readers >= 20 * runner_up)""")
def dominant_match(t):
    r = t("orders").select("o_custkey", "o_orderkey", F.floor(F.pow(F.col("o_totalprice") / 50000, F.lit(4))).cast("long").alias("readers"))
    return gates.dominant(r, ["o_custkey"], "readers", [F.col("o_orderkey")])


@query("""WITH n AS (SELECT o_custkey, count(*) AS total, list(o_orderkey ORDER BY o_totalprice DESC, o_orderkey) AS l FROM orders GROUP BY 1)
SELECT o_custkey, array_to_string(l[1:8], ',') AS shown, total, CASE WHEN total > 8 THEN '… and ' || (total - 8) || ' more' END AS more FROM n""")
def capped_listing(t):
    return gates.listed(t("orders"), ["o_custkey"], "o_orderkey", [F.desc("o_totalprice"), F.col("o_orderkey")], most=8).withColumn("shown", F.array_join("shown", ","))


@query("""WITH e AS (SELECT user_id, event_type AS a, event_id % 3 AS b FROM events), x AS (SELECT user_id, sum(n * (n - 1) // 2) AS p FROM (SELECT user_id, count(*) AS n FROM e GROUP BY user_id, a, b) GROUP BY 1),
y AS (SELECT user_id, sum(n * (n - 1) // 2) AS p FROM (SELECT user_id, count(*) AS n FROM e GROUP BY user_id, a) GROUP BY 1), z AS (SELECT user_id, sum(n * (n - 1) // 2) AS p FROM (SELECT user_id, count(*) AS n FROM e GROUP BY user_id, b) GROUP BY 1)
SELECT user_id, CAST(x.p AS BIGINT) AS pairs_both, CAST(y.p AS BIGINT) AS pairs_a, CAST(z.p AS BIGINT) AS pairs_b FROM x JOIN y USING (user_id) JOIN z USING (user_id)""")
def roster_agreement(t):
    return gates.agreement(t("events").select("user_id", F.col("event_type").alias("a"), (F.col("event_id") % 3).alias("b")), ["user_id"], "a", "b")


@query("""WITH c AS (SELECT count(*) FILTER (l_discount IS NULL OR l_discount < 0 OR l_discount > 0.08) AS a, count(*) FILTER (l_shipdate IS NULL) AS b, count(*) FILTER (l_returnflag IS NULL OR l_returnflag NOT IN ('A', 'N')) AS c FROM lineitem)
SELECT unnest(['discount in range', 'shipped', 'flag known']) AS signal, unnest([a, b, c]) AS broken, unnest([a, b, c]) = 0 AS ok FROM c""")
def gate_checks(t):
    return gates.checks(t("lineitem"), {"discount in range": F.col("l_discount").between(0, 0.08), "shipped": F.col("l_shipdate").isNotNull(), "flag known": F.col("l_returnflag").isin("A", "N")})


@query("""WITH RECURSIVE p AS (SELECT p_partkey AS n, p_name || '|' || p_brand || '|' || p_size AS k1, p_type || '|' || p_partkey // 8 AS k2, p_name, p_retailprice FROM part),
l AS (SELECT x.n AS a, y.n AS b FROM p x JOIN p y ON x.k1 = y.k1 OR x.k2 = y.k2), r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a), c AS (SELECT a AS n, min(b) AS root FROM r GROUP BY 1)
SELECT root, count(*) AS members, arg_max(n, [p_retailprice, length(p_name), -n]) AS canonical, arg_max(p_name, [p_retailprice, length(p_name), -n]) AS canonical_name FROM c JOIN p USING (n) GROUP BY 1""")
def person_clusters(t):
    p = t("part").select(F.col("p_partkey").alias("node"), "p_name", "p_brand", "p_size", "p_type", "p_retailprice", F.expr("p_partkey div 8").alias("near"))
    links = clusters.chained(p, ["p_name", "p_brand", "p_size"], "node", "node").unionByName(clusters.chained(p, ["p_type", "near"], "node", "node"))
    members = p.join(clusters.components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    return clusters.canonical(members, "root", "p_retailprice", "p_name", "node")


_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '')"


@query(f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL), g AS (SELECT doc_id, unnest(range(len(w) - 3)) AS pos, w FROM d WHERE len(w) > 3), h AS (SELECT doc_id, pos, array_to_string(w[pos + 1 : pos + 4], ' ') AS phrase FROM g),
q AS (SELECT item_id, array_to_string({_WORDS}[1:4], ' ') AS phrase FROM benchmark WHERE len({_WORDS}) > 3) SELECT item_id, doc_id, count(*) AS n, CAST(min(pos) AS INT) AS first_at FROM q JOIN h USING (phrase) GROUP BY 1, 2""")
def phrase_search(t):
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{M}\p{N}]+"), lambda x: x != "")

    def phrase(at):
        return F.concat_ws(" ", F.slice("w", at, 4))

    d = t("documents").select("doc_id", words.alias("w")).filter("size(w) > 3")
    h = d.select("doc_id", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("w") - 3), phrase)).alias("at", "phrase"))
    q = t("benchmark").select("item_id", words.alias("w")).filter("size(w) > 3").select("item_id", phrase(F.lit(1)).alias("phrase"))
    return h.join(q, "phrase").groupBy("item_id", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first_at"))


@query("""WITH e AS (SELECT user_id, ts, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 30 MINUTE AS far FROM events), s AS (SELECT user_id, ts, count(*) FILTER (coalesce(far, TRUE)) OVER (PARTITION BY user_id ORDER BY ts) AS i FROM e)
SELECT user_id, min(ts) AS begun, max(ts) AS last_event, count(*) AS n, max(ts) < (SELECT max(ts) FROM events) - INTERVAL 30 MINUTE AS silent FROM s GROUP BY user_id, i""")
def run_liveness(t):
    e = t("events")
    s = windows.sessions(e, "ts", ["user_id"], "30 minutes")
    return s.withColumn("silent", F.col("last_event") < e.agg((F.max("ts") - F.expr("INTERVAL 30 MINUTES")).alias("now")).scalar())
