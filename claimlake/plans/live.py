"""Live runs over events: display rows, the grid of judged pairs, changes of a run's state. Each query has DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import console
from .queries import query

def console_events(t):
    """Console events that the events table stands for: a run and a book for each user."""
    n = F.col("event_id")
    kind = F.when(F.col("event_type") == "view", "candidate_upsert").when(F.col("event_type").isin("click", "purchase"), "verdict_upsert").when(F.col("event_type") == "signup", "stage_state").otherwise("counts_snapshot")
    key = F.concat(F.lit("k"), (n % 7).cast("string"))
    record = F.struct((n % 13 == 0).alias("not_selected"), F.lit("x").alias("decision"))
    decision, final = F.when(F.col("value") > 50, "keep").otherwise("drop"), F.when(F.col("event_type") == "purchase", F.when(n % 2 == 0, "validated").otherwise("guessed"))
    payload = F.to_json(F.struct(F.when(kind == "candidate_upsert", "relationships").alias("table"), F.when(kind == "candidate_upsert", key).alias("key"), F.when(kind == "verdict_upsert", key).alias("row_key"), F.when(kind == "candidate_upsert", record).alias("record"), F.when(kind == "verdict_upsert", decision).alias("decision"), F.when((kind == "verdict_upsert") & (n % 3 == 0), (n % 101) / 100.0).alias("p"), final.alias("final_state")))
    return t("events").select(F.when(n % 11 == 0, 2).otherwise(1).alias("v"), n.alias("seq"), F.lit(None).cast("double").alias("ts"), F.lit("r").alias("run_id"), F.col("user_id").cast("string").alias("book_id"), F.lit(None).cast("string").alias("stage"), kind.alias("kind"), payload.alias("payload"))


_ROWS = """e AS (SELECT *, 'relationships/k' || (event_id % 7) AS item FROM events WHERE event_id % 11 <> 0 AND event_type IN ('view', 'click', 'purchase')),
b AS (SELECT user_id, item, max(event_id) FILTER (event_type = 'view') AS began FROM e GROUP BY 1, 2), l AS (SELECT e.*, began FROM e JOIN b USING (user_id, item) WHERE began IS NULL OR event_id >= began),
r AS (SELECT CAST(user_id AS VARCHAR) AS book_id, item, bool_or(event_type = 'view' AND event_id % 13 = 0) AS lost, arg_max(CASE WHEN value > 50 THEN 'keep' ELSE 'drop' END, event_id) FILTER (event_type <> 'view') AS decision,
  arg_max((event_id % 101) / 100.0, event_id) FILTER (event_type <> 'view' AND event_id % 3 = 0) AS p, bool_or(event_type = 'purchase' AND event_id % 2 = 0) AS firm, max(event_id) FILTER (event_type <> 'view') AS said FROM l GROUP BY 1, 2)"""


@query(f"WITH {_ROWS} SELECT 'r' AS run_id, book_id, item, 'relationships' AS \"table\", CASE WHEN NOT lost THEN CASE WHEN said IS NULL THEN 'x' ELSE decision END END AS decision, CAST(p AS DOUBLE) AS p, CASE WHEN NOT lost AND firm THEN 'validated' END AS final_state FROM r")
def console_rows(t):
    return console.display_rows(console.newest(console.facts(console_events(t))))


@query(f"WITH {_ROWS} SELECT 'r' AS run_id, book_id, 'relationships' AS \"table\", count(*) AS n, count(*) > 2000 AS capped FROM r GROUP BY 2")
def console_counts(t):
    return console.row_counts(console.newest(console.facts(console_events(t))))


def run_events(t):
    """Run events that the events table stands for: a run for each user; sign-ups open a book, purchases are verdicts."""
    n = F.col("event_id")
    kind = F.when(F.col("event_type") == "signup", "book_start").when(F.col("event_type") == "purchase", "verdict").when(F.col("event_type") == "error", "run_end").otherwise("pair")
    book = F.when(F.col("event_type") == "signup", F.concat(F.lit("b"), F.dayofmonth("ts").cast("string"))).when(n % 6 == 0, "apart")
    a, b = (F.when(n % 17 != 0, F.concat(F.lit("n"), (n * m % k).cast("string"))) for m, k in ((1, 5), (3, 4)))
    verdict = kind == "verdict"
    return t("events").select(F.col("user_id").cast("string").alias("run_id"), n.alias("seq"), kind.alias("event"), book.alias("book"), a.alias("a"), b.alias("b"), F.when(n % 4 != 0, F.col("value")).alias("score"), F.when(verdict, F.when(n % 2 == 0, "yes").otherwise("no")).alias("verdict"), F.when(verdict, "judge").alias("via"), F.lit(None).cast("string").alias("reason"), "ts")


_PAIRS = """e AS (SELECT user_id, event_id, event_type, CASE WHEN event_type = 'signup' THEN 'b' || day(ts) WHEN event_id % 6 = 0 THEN 'apart' END AS own, last_value(CASE WHEN event_type = 'signup' THEN 'b' || day(ts) END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS bracket,
  'n' || (event_id % 5) AS a, 'n' || (event_id * 3 % 4) AS b, CASE WHEN event_id % 4 <> 0 THEN value END AS score FROM events),
p AS (SELECT CAST(user_id AS VARCHAR) AS run_id, coalesce(own, bracket) AS book, least(a, b) AS a, greatest(a, b) AS b, a AS first, b AS second, event_id AS seq, event_type = 'purchase' AS firm, score FROM e WHERE event_type NOT IN ('signup', 'error') AND event_id % 17 <> 0 AND coalesce(own, bracket) IS NOT NULL)"""


@query(f"""WITH {_PAIRS}, s AS (SELECT run_id, book, a, b, min(seq) FILTER (firm) AS settled FROM p GROUP BY 1, 2, 3, 4), l AS (SELECT p.*, settled FROM p JOIN s USING (run_id, book, a, b) WHERE settled IS NULL OR seq <= settled),
n AS (SELECT run_id, book, a, b, max(seq) AS pos, max(seq) FILTER (NOT firm OR score IS NOT NULL) AS scored FROM l GROUP BY 1, 2, 3, 4)
SELECT n.run_id, n.book, n.a, n.b, max(score) FILTER (seq = scored) AS score, CASE WHEN any_value(settled) IS NULL THEN 'scored' ELSE 'settled' END AS state, CASE WHEN any_value(settled) % 2 = 0 THEN 'yes' WHEN any_value(settled) IS NOT NULL THEN 'no' END AS verdict,
CASE WHEN any_value(settled) IS NOT NULL THEN 'judge' END AS via, CAST(NULL AS VARCHAR) AS reason, any_value(pos) AS seq FROM n JOIN l USING (run_id, book, a, b) GROUP BY 1, 2, 3, 4""")
def live_matrix(t):
    return console.matrix(run_events(t).drop("ts"))


@query(f"""WITH {_PAIRS}, n AS (SELECT run_id, book, first AS name, 2 * seq AS pos FROM p UNION ALL SELECT run_id, book, second, 2 * seq + 1 FROM p), f AS (SELECT run_id, book, name, min(pos) AS pos FROM n GROUP BY 1, 2, 3)
SELECT run_id, book, name, CAST(row_number() OVER (PARTITION BY run_id, book ORDER BY pos) - 1 AS INT) AS place FROM f""")
def matrix_names(t):
    return console.matrix_names(run_events(t).drop("ts"))


@query("""WITH e AS (SELECT CAST(user_id AS VARCHAR) AS run_id, event_type, event_id, epoch_us(ts) // 1000 AS ms FROM events), w AS (SELECT *, lag(ms) OVER o AS last, coalesce(count(*) FILTER (event_type = 'error') OVER (PARTITION BY run_id ORDER BY ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS over FROM e WINDOW o AS (PARTITION BY run_id ORDER BY ms, event_id))
SELECT run_id, 'interrupted' AS state, last + 86400000 AS since_ms FROM w WHERE over = 0 AND ms - last > 86400000
UNION ALL SELECT run_id, CASE WHEN event_type = 'error' THEN 'finished' ELSE 'running' END, ms FROM w WHERE over = 0 AND (event_type = 'error' OR last IS NULL OR ms - last > 86400000)""")
def run_state_changes(t):
    return console.run_states(run_events(t), silence=86_400)
