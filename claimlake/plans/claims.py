"""Names, evidence, scores and mutations over the given tables, each with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import evidence, names, scores
from ..operators import joins, reduce
from .queries import query

_HEAD = "substr(text, 1, 60)"
_BARE = f"strip_accents({_HEAD})"
_TIDY = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"
_PERSON = _TIDY.format(rf"regexp_replace(lower({_TIDY.format(_HEAD)}), '^(the|a|an)\s+', '')")
_LOW = f"regexp_replace(lower({_HEAD}), '[^a-z0-9]+', '{{0}}', 'g')"


@query(rf"""SELECT doc_id, trim(regexp_replace(lower({_BARE}), '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g')) AS plain_key,
{_PERSON} AS person_key, {_TIDY.format(f"replace(lower({_HEAD}), '_', ' ')")} AS title_key,
trim(regexp_replace(strip_accents(lower({_HEAD})), '[^a-z0-9]+', ' ', 'g')) AS series_key,
regexp_replace(trim(regexp_replace(strip_accents(lower({_HEAD})), '[^a-z0-9]+', ' ', 'g')), '^the ', '') AS work_key,
trim({_LOW.format(' ')}) AS fixture_key, coalesce(nullif(trim({_LOW.format('-')}, '-'), ''), 'unknown-book') AS slug
FROM documents WHERE text IS NOT NULL""")
def name_keys(t):
    head = F.substring("text", 1, 60)
    keys = {"plain_key": names.norm, "person_key": names.norm_name, "title_key": names.tidy_title, "series_key": names.name_key, "work_key": names.work_key, "fixture_key": names.fixture_key, "slug": names.slug}
    return t("documents").filter("text IS NOT NULL").select("doc_id", *(f(head).alias(k) for k, f in keys.items()))


_SUM10 = " + ".join(f"CAST(substr(s, {i + 1}, 1) AS INT) * {10 - i}" for i in range(10))
_SUM13 = " + ".join(f"CAST(substr('978' || s, {i + 1}, 1) AS INT) * {3 if i % 2 else 1}" for i in range(12))


@query(f"""WITH c AS (SELECT o_orderkey, lpad(CAST(o_orderkey * 7919 % 10000000000 AS VARCHAR), 10, '0') AS s FROM orders)
SELECT o_orderkey, s AS isbn10, '978' || left(s, 9) || CAST((10 - ({_SUM13}) % 10) % 10 AS VARCHAR) AS isbn13 FROM c WHERE ({_SUM10}) % 11 = 0""")
def isbn_forms(t):
    written = F.lpad((F.col("o_orderkey") * 7919 % 10_000_000_000).cast("string"), 10, "0")
    spaced = F.concat(F.lit("urn:isbn:"), F.left(written, F.lit(4)), F.lit("-"), F.substring(written, 5, 6))
    return t("orders").select("o_orderkey", names.valid_isbn(spaced).alias("isbn10"), names.isbn13(spaced).alias("isbn13")).filter("isbn10 IS NOT NULL")


_PIECES = r"""p AS (SELECT doc_id, text, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])[ \t\n\r\f]+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x, chr(32) || chr(9) || chr(10) || chr(12) || chr(13))), lambda x: x <> '') AS pieces FROM documents WHERE text IS NOT NULL)"""


@query(f"""WITH {_PIECES} SELECT doc_id, CAST(len(pieces) AS INT) AS n_sentences, md5(coalesce(array_to_string(pieces, '|'), '')) AS sentences_hash,
greatest(1, CAST(ceil(length(text) / 4.0) AS BIGINT)) AS tokens, CASE WHEN length({_TIDY.format('text')}) <= 80 THEN {_TIDY.format('text')} ELSE left({_TIDY.format('text')}, 79) || '…' END AS excerpt FROM p""")
def sentence_pieces(t):
    d, s = t("documents").filter("text IS NOT NULL"), evidence.sentences("text")
    return d.select("doc_id", F.size(s).alias("n_sentences"), F.md5(F.array_join(s, "|")).alias("sentences_hash"), evidence.estimated_tokens("text").alias("tokens"), evidence.excerpt("text", 80).alias("excerpt"))


#: The sentences around each text's fourth one, found again in it, as CTE x.
WINDOWS = rf"""{_PIECES}, q AS (SELECT doc_id, pieces, list_transform(pieces, lambda x: {_TIDY.format('x')}) AS plain FROM p WHERE len(pieces) >= 4),
u AS (SELECT doc_id, unnest(range(len(plain))) AS i, unnest(plain) AS piece, strpos(array_to_string(plain, ' '), plain[4]) - 1 AS a, length(plain[4]) AS n FROM q),
w AS (SELECT *, sum(length(piece) + 1) OVER (PARTITION BY doc_id ORDER BY i) - 1 AS nxt FROM u),
f AS (SELECT doc_id, min(i) FILTER (nxt >= a) AS first, min(i) FILTER (nxt >= a + n - 1) AS last FROM w GROUP BY 1),
x AS (SELECT doc_id, CAST(first AS INT) AS first, CAST(last AS INT) AS last, md5(left(array_to_string(list_concat(pieces[greatest(first - 2, 0) + 1 : first], pieces[last + 2 : last + 3]), ' '), 1200)) AS window_hash FROM f JOIN q USING (doc_id))"""


@query(f"WITH {WINDOWS} SELECT * FROM x")
def evidence_windows(t):
    # the quote: a document's fourth sentence, found again in the whole text; the generator tells each text's sentences once
    def found(pieces):
        return names.let(evidence.located(F.get(pieces, F.lit(3)), pieces), lambda span: F.struct(span["first"].alias("first"), span["last"].alias("last"), F.md5(evidence.surroundings(span, pieces)).alias("window_hash")))

    rows = F.filter(F.transform(F.array(evidence.sentences("text")), found), lambda r: r["first"].isNotNull())
    return t("documents").filter("text IS NOT NULL").select("doc_id", F.inline(rows))


#: Claims that events stand for: a score in hundredths, unanswered at times, and a type.
_CLAIMS = "SELECT *, CASE WHEN event_id % 9 <> 0 THEN (event_id * 37 % 101) / 100.0 END AS p, CASE event_type WHEN 'view' THEN 'parent' WHEN 'click' THEN 'sibling' WHEN 'error' THEN NULL ELSE event_type END AS kind FROM events"
_BAND = "CASE WHEN p IS NULL THEN 'unanswered' WHEN kind IN ('spouse', 'parent', 'child', 'sibling') THEN CASE WHEN p >= 0.7 THEN 'keep' WHEN p < 0.3 THEN 'drop' ELSE 'middle' END WHEN p >= 0.3 THEN 'keep' ELSE 'drop' END"


def _claims(t):
    kind = F.when(F.col("event_type") == "view", "parent").when(F.col("event_type") == "click", "sibling").when(F.col("event_type") != "error", F.col("event_type"))
    return t("events").withColumn("p", F.when(F.col("event_id") % 9 != 0, (F.col("event_id") * 37 % 101) / 100.0)).withColumn("kind", kind)


@query(f"""WITH c AS ({_CLAIMS}) SELECT kind, {_BAND} AS band, CASE WHEN abs(p - 0.3) <= 0.15 + 1e-9 OR kind IN ('spouse', 'parent', 'child', 'sibling') AND abs(p - 0.7) <= 0.15 + 1e-9 THEN 5 ELSE 3 END AS draws, count(*) AS n FROM c GROUP BY ALL""")
def claim_bands(t):
    return _claims(t).groupBy("kind", scores.band(F.col("p"), F.col("kind")).alias("band"), scores.draw_count(F.col("p"), F.col("kind")).alias("draws")).agg(F.count(F.lit(1)).alias("n"))


_CASES = f"""c AS ({_CLAIMS}), o AS (SELECT user_id, kind, CASE WHEN count(p) = 0 THEN 'unanswered' WHEN min(CASE WHEN p IS NOT NULL THEN {_BAND} END) = max(CASE WHEN p IS NOT NULL THEN {_BAND} END) THEN min(CASE WHEN p IS NOT NULL THEN {_BAND} END) ELSE 'unstable' END AS outcome,
median(p) AS median, max(p) - min(p) AS spread, count(p) AS answers FROM c GROUP BY 1, 2)"""


@query(f"WITH {_CASES} SELECT user_id, kind, outcome, round(median, 6) AS median, round(spread, 6) AS spread, answers FROM o")
def draw_outcomes(t):
    return reduce.case_outcomes(_claims(t), ["user_id", "kind"], "p", scores.band(F.col("p"), F.col("kind"))).withColumns({c: F.round(c, 6) for c in ("median", "spread")})


@query(f"""WITH c AS ({_CLAIMS}), o AS (SELECT event_type, {_BAND} AS outcome, CASE WHEN user_id % 2 = 0 THEN 'keep' ELSE 'drop' END AS expect FROM c)
SELECT event_type, count(*) AS cases, count(*) FILTER (outcome = 'keep') AS pred_keep, count(*) FILTER (expect = 'keep') AS exp_keep, count(*) FILTER (outcome = 'keep' AND expect = 'keep') AS true_keep,
count(*) FILTER (outcome IN ('keep', 'drop')) AS decided, count(*) FILTER (outcome = expect) AS exact, count(*) FILTER (outcome IN ('middle', 'unstable', 'unanswered')) AS abstained FROM o GROUP BY 1""")
def headline_metrics(t):
    c = _claims(t).withColumn("outcome", scores.band(F.col("p"), F.col("kind"))).withColumn("expect", F.when(F.col("user_id") % 2 == 0, "keep").otherwise("drop"))
    return reduce.headline(c, ["event_type"], "outcome", "expect")


@query(f"""WITH c AS ({_CLAIMS}), n AS (SELECT CAST(t AS DOUBLE) AS threshold, count(*) FILTER (p >= t AND y) AS tp, count(*) FILTER (p >= t AND NOT y) AS fp, count(*) FILTER (p < t AND NOT y) AS tn, count(*) FILTER (p < t AND y) AS fn, count(*) FILTER (p IS NULL) AS unanswered
FROM (SELECT p, value > 50 AS y FROM c), (VALUES (0.5), (0.85), (2.0)) AS v(t) GROUP BY t)
SELECT *, CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END AS recall FROM n""")
def judge_summary(t):
    return reduce.score_summary(_claims(t), "p", F.col("value") > 50, [0.5, 0.85, 2.0])


@query("""WITH s AS (SELECT lang, n_chars, quality = 1 AS y FROM documents JOIN labels USING (doc_id) WHERE n_chars IS NOT NULL),
r AS (SELECT *, avg(rn) OVER (PARTITION BY lang, n_chars) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars) AS rn FROM s)),
g AS (SELECT lang, count(*) AS n, count(*) FILTER (y) AS p, sum(rank) FILTER (y) AS ranks FROM r GROUP BY 1)
SELECT lang, n, CASE WHEN p > 0 AND n > p THEN round((ranks - p * (p + 1) / 2.0) / (p * (n - p)), 9) END AS auc FROM g""")
def length_separation(t):
    s = t("documents").join(t("labels").select("doc_id", "quality"), "doc_id")
    return reduce.separation(s, ["lang"], "n_chars", F.col("quality") == 1).withColumn("auc", F.round("auc", 9))


@query("""SELECT user_id AS o_custkey, arg_max(event_type, event_id) AS status FROM events GROUP BY 1 UNION ALL SELECT o_custkey, min(o_orderstatus) FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events) GROUP BY 1""")
def upsert_last_wins(t):
    old = t("orders").groupBy("o_custkey").agg(F.min("o_orderstatus").alias("status"))
    new = t("events").select(F.col("user_id").alias("o_custkey"), F.col("event_type").alias("status"), "event_id")
    return joins.upsert(old.withColumn("event_id", F.lit(0).cast("long")), new, ["o_custkey"], [F.col("event_id")]).drop("event_id")


@query("""SELECT c_custkey AS user_id, c_name AS name FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT user_id, arg_min(event_type, event_id) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) GROUP BY 1""")
def insert_first_wins(t):
    old = t("customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), F.lit(0).cast("long").alias("event_id"))
    return joins.insert_missing(old, t("events").select("user_id", F.col("event_type").alias("name"), "event_id"), ["user_id"], [F.col("event_id")]).drop("event_id")


@query("""WITH x AS (SELECT user_id, event_id, event_type = 'purchase' AND value > 60 AS firm, CASE WHEN event_id % 4 <> 0 THEN event_id * 3 END AS v FROM events),
s AS (SELECT user_id, min(event_id) FILTER (firm) AS settled_at FROM x GROUP BY 1),
b AS (SELECT x.*, settled_at FROM x JOIN s ON x.user_id = s.user_id WHERE settled_at IS NULL OR event_id <= settled_at),
l AS (SELECT user_id, max(event_id) AS last_id FROM b WHERE NOT firm OR v IS NOT NULL GROUP BY 1)
SELECT b.user_id, any_value(settled_at) AS settled_at, max(v) FILTER (event_id = last_id) AS last_value, count(*) AS n_before FROM b LEFT JOIN l ON b.user_id = l.user_id GROUP BY 1""")
def freeze_full(t):
    x = t("events").withColumn("v", F.when(F.col("event_id") % 4 != 0, F.col("event_id") * 3))
    return reduce.frozen(x, ["user_id"], "event_id", (F.col("event_type") == "purchase") & (F.col("value") > 60), "v")


@query("""SELECT l_orderkey, l_linenumber, 'new' AS origin FROM lineitem WHERE l_orderkey % 5 = 0 AND l_linenumber <= 2
UNION ALL SELECT l_orderkey, l_linenumber, 'old' FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey % 5 = 0 AND l_linenumber <= 2)""")
def replaced_wholesale(t):
    rows = t("lineitem").select("l_orderkey", "l_linenumber")
    new = rows.filter("l_orderkey % 5 = 0 AND l_linenumber <= 2").withColumn("origin", F.lit("new"))
    return joins.replace_wholesale(rows.withColumn("origin", F.lit("old")), new, ["l_orderkey"])


#: Lines as a store's rows: some rulings, some rows without a status.
_STATUS = "CASE WHEN l_returnflag = 'A' THEN 'confirmed' WHEN l_linenumber = 3 THEN NULL WHEN l_linenumber = 4 THEN '' WHEN l_linenumber = 5 THEN 'rejected' ELSE 'pending' END"


@query(f"""WITH l AS (SELECT *, {_STATUS} AS status FROM lineitem), o AS (SELECT l_orderkey, l_linenumber, status, NOT coalesce(l_linestatus = 'O' AND status <> '' AND status NOT IN ('confirmed', 'rejected'), FALSE) AS stays FROM l), g AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey % 3 = 0)
SELECT l_orderkey, l_linenumber, status, 'old' AS origin FROM o WHERE stays OR l_orderkey NOT IN (SELECT l_orderkey FROM g)
UNION ALL SELECT l_orderkey, l_linenumber, 'pending', 'new' FROM lineitem WHERE l_orderkey % 3 = 0 AND (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM o WHERE stays)""")
def replaced_uncurated(t):
    rows = t("lineitem").select("l_orderkey", "l_linenumber", F.expr(_STATUS).alias("status"), "l_linestatus")
    new = rows.filter("l_orderkey % 3 = 0").withColumn("status", F.lit("pending")).withColumn("origin", F.lit("new"))
    old = rows.withColumn("origin", F.lit("old"))
    return joins.replace_uncurated(old, new, ["l_orderkey", "l_linenumber"], ["l_orderkey"], F.col("l_linestatus") == "O", F.col("status")).drop("l_linestatus")


@query("""WITH m AS (SELECT CASE WHEN user_id % 10 = 3 THEN user_id + 1 ELSE user_id END AS user_id, user_id % 10 = 3 AS moved, event_type, min(event_id) AS decided FROM events GROUP BY ALL)
SELECT user_id, event_type, arg_min(decided, moved) AS decided FROM m GROUP BY 1, 2""")
def identity_rename(t):
    ledger = t("events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("decided"))
    old = F.when(F.col("user_id") % 10 == 3, F.col("user_id"))
    return joins.renamed_identity(ledger, "user_id", ["event_type"], old, F.col("user_id") + 1)


@query("""WITH f AS (SELECT user_id, event_type, min(event_id) AS at FROM events GROUP BY 1, 2)
SELECT e.event_id, coalesce(string_agg(f.event_type, ',' ORDER BY f.at), '') AS known FROM events e LEFT JOIN f ON f.user_id = e.user_id AND f.at < e.event_id GROUP BY 1""")
def roster_before(t):
    return reduce.state_before(t("events"), ["user_id"], "event_id", "event_type").select("event_id", F.array_join("known", ",").alias("known"))


@query("""WITH d AS (SELECT user_id, event_type, CAST(day(ts) AS INT) AS chapter, count(*) AS n, min(event_id) AS seq FROM events GROUP BY 1, 2, 3)
SELECT user_id, event_type, CAST(sum(n) AS BIGINT) AS occurrences, string_agg(CAST(chapter AS VARCHAR), ',' ORDER BY seq) AS chapters, arg_min(chapter, seq) AS first_chapter FROM d GROUP BY 1, 2""")
def proposal_recurrence(t):
    e = t("events").withColumn("chapter", F.dayofmonth("ts"))
    return reduce.recurrences(e, ["user_id", "event_type"], "chapter", "event_id").withColumn("chapters", F.array_join("chapters", ","))


_TOKENS = "list_filter(string_split(regexp_replace(array_to_string(regexp_extract_all(regexp_replace(lower({0}), '\\s*\\([^)]*\\)', '', 'g'), '[a-z0-9'']+'), ' '), '^(?:(?:" + "|".join(names.TITLES) + ")(?: |$))+', ''), ' '), lambda x: x <> '')"
_INSIDE = "least(len(x), len(y)) >= 2 AND (contains(' ' || array_to_string(x, ' ') || ' ', ' ' || array_to_string(y, ' ') || ' ') OR contains(' ' || array_to_string(y, ' ') || ' ', ' ' || array_to_string(x, ' ') || ' '))"


@query(f"""WITH n AS (SELECT p_partkey, p_name, lag(p_name) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS before FROM part), k AS (SELECT p_partkey, {_TOKENS.format('p_name')} AS x, {_TOKENS.format("'Dr. ' || before")} AS y FROM n WHERE before IS NOT NULL)
SELECT p_partkey, CASE WHEN len(x) = 0 OR len(y) = 0 THEN 'ambiguous' WHEN len(x) >= 2 AND len(y) >= 2 AND x[1] <> y[1] AND x[-1] = y[-1] THEN 'no' WHEN x = y OR {_INSIDE} THEN 'yes' ELSE 'ambiguous' END AS verdict FROM k""")
def pair_classes(t):
    from pyspark.sql import Window

    n = t("part").withColumn("before", F.lag("p_name").over(Window.partitionBy("p_brand").orderBy("p_partkey"))).filter("before IS NOT NULL")
    return n.select("p_partkey", names.same_person(names.name_tokens("p_name"), names.name_tokens(F.concat(F.lit("Dr. "), F.col("before")))).alias("verdict"))


@query("""WITH v AS (SELECT vec_id, embedding, label FROM embeddings), p AS (SELECT a.vec_id, b.vec_id AS next_id, a.embedding AS x, b.embedding AS y FROM v a JOIN v b ON b.vec_id = a.vec_id + 1)
SELECT vec_id, round(CASE WHEN list_sum(list_transform(x, lambda i: CAST(i AS DOUBLE) * i)) > 0 AND list_sum(list_transform(y, lambda i: CAST(i AS DOUBLE) * i)) > 0 THEN list_sum(list_transform(list_zip(x, y), lambda i: CAST(i[1] AS DOUBLE) * i[2])) / (sqrt(list_sum(list_transform(x, lambda i: CAST(i AS DOUBLE) * i))) * sqrt(list_sum(list_transform(y, lambda i: CAST(i AS DOUBLE) * i)))) ELSE 0 END, 6) AS cosine FROM p""")
def neighbour_cosine(t):
    v = t("embeddings")
    other = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return v.join(other, "vec_id").select("vec_id", F.round(scores.cosine(F.col("embedding"), F.col("other")), 6).alias("cosine"))


@query(f"""WITH c AS ({_CLAIMS}), x AS (SELECT *, CASE event_id % 4 WHEN 0 THEN 'validated' WHEN 1 THEN 'review_required' WHEN 2 THEN 'rejected' END AS state, CASE event_id % 5 WHEN 0 THEN 'downgraded' WHEN 1 THEN ' Downgrade ' END AS note FROM c)
SELECT coalesce(state, '') = 'validated' AND coalesce(note, '') <> 'downgraded' AS confirmed, CASE WHEN event_id % 3 <> 0 THEN 'dropped' WHEN lower(trim(coalesce(note, ''))) IN ('downgraded', 'downgrade') OR (kind IS DISTINCT FROM event_type) THEN 'downgraded' ELSE 'shipped' END AS disposition, count(*) AS n FROM x GROUP BY 1, 2""")
def claim_dispositions(t):
    state = F.when(F.col("event_id") % 4 == 0, "validated").when(F.col("event_id") % 4 == 1, "review_required").when(F.col("event_id") % 4 == 2, "rejected")
    note = F.when(F.col("event_id") % 5 == 0, "downgraded").when(F.col("event_id") % 5 == 1, " Downgrade ")
    done = scores.disposition(F.col("event_id") % 3 == 0, note, F.col("event_type"), F.col("kind"))
    return _claims(t).groupBy(scores.shipped_confirmed(state, note, F.col("kind")).alias("confirmed"), done.alias("disposition")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderkey, CASE WHEN s < 0.06 THEN 'rare' WHEN s < 0.15 THEN 'occasional' WHEN s < 0.35 THEN 'frequent' ELSE 'pervasive' END AS frequency, CASE WHEN k <= 0 THEN 0 WHEN k <= 1 THEN 1 WHEN k <= 3 THEN 2 ELSE 3 END AS peak,
CASE WHEN v AND NOT a THEN 'protagonist' WHEN s >= 0.30 OR v THEN CASE WHEN a THEN 'antagonist' ELSE 'protagonist' END WHEN s >= 0.10 THEN CASE WHEN a THEN 'antagonist' ELSE 'supporting' END ELSE 'minor' END AS role,
least(250, greatest(50, n)) AS pool, greatest(least(250, greatest(50, n)), least(250, greatest(50, 40 + CAST(ceil(n * 1.05) AS INT) + 15))) AS resized, greatest(3, n // 20) AS floor, date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-01-01') >= 180 AS stale
FROM (SELECT o_orderkey, o_orderdate, (o_orderkey % 50) / 100.0 AS s, CAST(o_orderkey % 6 AS INT) AS k, o_orderkey % 11 = 0 AS v, o_orderkey % 7 = 0 AS a, CAST(o_orderkey % 400 AS INT) AS n FROM orders)""")
def reduce_bands(t):
    o = t("orders").select("o_orderkey", "o_orderdate", ((F.col("o_orderkey") % 50) / 100.0).alias("s"), (F.col("o_orderkey") % 6).cast("int").alias("k"), (F.col("o_orderkey") % 11 == 0).alias("v"), F.when(F.col("o_orderkey") % 7 == 0, "antagonist").alias("a"), (F.col("o_orderkey") % 400).cast("int").alias("n"))
    pool = scores.decision_pool(F.col("n"))
    return o.select(
        "o_orderkey",
        scores.frequency_band(F.col("s")).alias("frequency"),
        scores.peak_band(F.col("k")).alias("peak"),
        scores.role(F.col("v"), F.col("s"), F.col("a")).alias("role"),
        pool.alias("pool"),
        scores.resized_pool(pool, F.lit(40), F.col("n"), F.lit(15)).alias("resized"),
        scores.support_floor(F.col("n")).cast("int").alias("floor"),
        scores.stale(F.col("o_orderdate").cast("date"), F.lit("1998-01-01").cast("date")).alias("stale"),
    )
