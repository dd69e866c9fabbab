"""Store import over artefacts that events stand for: a work for each user and day, a claim for each event. Each query has DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import previews
from .queries import query

_ROWS = """e AS (SELECT 'u' || user_id || '-' || day(ts) AS work_id, event_id AS pos, event_id % 3 AS list, event_type, 'n' || (event_id % 7) AS f, 'n' || (event_id % 5) AS t, event_type AS type, CAST(day(ts) AS VARCHAR) AS chapter,
CASE WHEN event_id % 9 <> 0 THEN (event_id * 37 % 101) / 100.0 END AS p, CASE event_id % 4 WHEN 0 THEN 'validated' WHEN 1 THEN 'review_required' WHEN 2 THEN 'rejected' END AS state, CASE WHEN event_id % 5 = 0 THEN 'downgraded' END AS note FROM events)"""
_STORED = "s AS (SELECT work_id, f AS name FROM e WHERE event_type = 'view' UNION SELECT work_id, f FROM e WHERE list < 2 AND (state = 'validated' OR state = 'review_required' AND p IS NOT NULL))"
_FIRST = "arg_min({0}, list * 1000000000000 + pos)"
_DROPPED = f"d AS (SELECT work_id, f, t, type, chapter, {_FIRST.format('coalesce(note, state, %s)' % repr('dropped'))} AS state, {_FIRST.format('struct_pack(p := p)')}.p AS score FROM e WHERE list = 2 OR state = 'rejected' GROUP BY 1, 2, 3, 4, 5)"
_UNCONFIRMED = "NOT (coalesce(state, '') = 'validated' AND coalesce(note, '') <> 'downgraded')"
_MISSED = f"""m AS (SELECT work_id, f, t, type, chapter, {_FIRST.format('coalesce(note, state, %s)' % repr('unconfirmed'))} AS state, {_FIRST.format('struct_pack(p := p)')}.p AS score FROM e
WHERE list < 2 AND p IS NOT NULL AND {_UNCONFIRMED} AND (work_id, f) IN (SELECT (work_id, name) FROM s) AND (work_id, f, t, type, chapter) NOT IN (SELECT (work_id, f, t, type, chapter) FROM d) GROUP BY 1, 2, 3, 4, 5)"""
_MERGES = "g AS (SELECT work_id, least('n' || (pos % 4), 'n' || (pos % 3)) AS a, greatest('n' || (pos % 4), 'n' || (pos % 3)) AS b, arg_min(struct_pack(p := p), pos).p AS score FROM e WHERE event_type = 'signup' GROUP BY 1, 2, 3)"


def _artefacts(t):
    """One JSON object for each user and day, read back by the artefact reader; no busy user's events come together whole.

    A day's events are gathered and sorted once, as ids and types; the lists of its object are made of them there, so that no claim travels before it is read.
    """

    def named(c, of):
        return F.concat(F.lit("n"), (c["event_id"] % of).cast("string"))

    def score(c):
        n = c["event_id"]
        return F.when(n % 9 != 0, (n * 37 % 101) / 100.0)

    def claim(c):
        n = c["event_id"]
        state = F.when(n % 4 == 0, "validated").when(n % 4 == 1, "review_required").when(n % 4 == 2, "rejected")
        return F.struct(named(c, 7).alias("from"), named(c, 5).alias("to"), c["event_type"].alias("type"), F.col("day").cast("string").alias("chapter"), score(c).alias("validation_p"), state.alias("validation_state"), F.when(n % 5 == 0, "downgraded").alias("validation_note"))

    def merge(c):
        return F.struct(named(c, 4).alias("name_a"), named(c, 3).alias("name_b"), score(c).alias("p_yes"))

    def person(c):
        return F.struct(named(c, 7).alias("name"), F.array(F.concat(named(c, 7), F.lit(" of old"))).alias("unresolved_mentions"))

    def of(i):
        return lambda c: c["event_id"] % 3 == i  # filter would give a second argument the place

    def listed(item, when):
        return F.transform(F.filter("events", when), item)

    works = t("events").groupBy("user_id", F.dayofmonth("ts").alias("day")).agg(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))).alias("events"))
    texts = works.select(
        F.concat_ws("-", F.concat(F.lit("u"), F.col("user_id").cast("string")), F.col("day").cast("string")).alias("work_id"),
        *(listed(claim, of(i)).alias(name) for i, name in enumerate(previews.CLAIM_LISTS)),
        listed(person, lambda c: c["event_type"] == "view").alias("characters"),
        listed(person, lambda c: c["event_type"] == "click").alias("minor_characters"),
        listed(merge, lambda c: c["event_type"] == "signup").alias("possible_merges"),
    )
    return previews.parsed(texts.select(F.to_json(F.struct("*")).alias("value"), F.concat("work_id", F.lit(".json")).alias("file")))


@query(f"WITH {_ROWS}, r AS (SELECT work_id, f AS name, CASE event_type WHEN 'view' THEN 0 ELSE 1 END AS list FROM e WHERE event_type IN ('view', 'click')) SELECT work_id, name, CAST(min(list) AS INT) AS list FROM r GROUP BY 1, 2")
def import_roster(t):
    return previews.people(_artefacts(t)).select("work_id", "name", "list")


@query(f"WITH {_ROWS}, {_STORED} SELECT work_id, name FROM s")
def import_stored_names(t):
    return previews.stored_names(_artefacts(t))


@query(f"WITH {_ROWS}, {_DROPPED} SELECT work_id, f AS source, t AS target, type, chapter, state, score FROM d")
def import_dropped_claims(t):
    return previews.dropped_claims(_artefacts(t)).select("work_id", F.col("from").alias("source"), F.col("to").alias("target"), "type", "chapter", "state", "score")


@query(f"WITH {_ROWS}, {_STORED}, {_DROPPED}, {_MISSED} SELECT work_id, f AS source, t AS target, type, chapter, state, score FROM m")
def import_near_misses(t):
    return previews.near_misses(_artefacts(t)).select("work_id", F.col("from").alias("source"), F.col("to").alias("target"), "type", "chapter", "state", "score")


@query(f"WITH {_ROWS}, {_MERGES} SELECT work_id, a || '|' || b AS pair, 'left_for_review' AS state, score FROM g")
def import_merges(t):
    return previews.merges(_artefacts(t)).select("work_id", "pair", "state", "score")


@query(f"WITH {_ROWS} SELECT DISTINCT work_id, f AS character, f || ' of old' AS mention FROM e WHERE event_type IN ('view', 'click')")
def import_mentions(t):
    return previews.mentions(_artefacts(t)).select("work_id", "character", "mention")


@query(f"""WITH {_ROWS}, {_STORED}, {_DROPPED}, {_MISSED}, {_MERGES},
o AS (SELECT work_id, f, t, type, chapter, {_FIRST.format('coalesce(note, state, %s)' % repr('unconfirmed'))} AS state, {_FIRST.format('struct_pack(p := p)')}.p AS score FROM e WHERE list < 2 AND p >= 0.3 AND {_UNCONFIRMED} AND (work_id, f) NOT IN (SELECT (work_id, name) FROM s) GROUP BY 1, 2, 3, 4, 5),
k AS (SELECT * FROM (SELECT *, 0 AS rank FROM d UNION ALL SELECT *, 0 FROM m) WHERE score >= 0.3 UNION ALL SELECT *, 1 FROM o WHERE (work_id, f, t, type, chapter) NOT IN (SELECT (work_id, f, t, type, chapter) FROM d WHERE score >= 0.3))
SELECT work_id, 'claim' AS kind, f || ' → ' || t AS label, type, score, state AS reason FROM k
UNION ALL SELECT work_id, 'merge', a || ' ↔ ' || b, 'merge', score, 'left_for_review' FROM g WHERE score >= 0.3 AND score < 0.85""")
def import_alerts(t):
    return previews.alerts(_artefacts(t))
