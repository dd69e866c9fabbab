"""Rulings of people: verbs that set and take back, proposals beside what was rejected, a report of books. Null keys are a key of their own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import evidence, scores
from .joins import anti


def _same(a: dict[str, str]) -> Column:
    return reduce(Column.__and__, (F.col(x).eqNullSafe(F.col(y)) for x, y in a.items()))


def ruled(verbs: DataFrame, keys: list[str], order: list[str], verb: str, sets: str, takes_back: str, may_set: Column, why: str) -> DataFrame:
    """verbs with accepted and refusal: which of them take effect, in order.

    One that sets is refused, with why, where may_set does not hold; setting again is accepted and renews the row. One that
    takes back is refused as nothing to remove where nothing stands. Any other verb is refused as unknown. As a refused
    verb changes nothing, what stands before a row follows from the last accepted set or any take-back before it.
    """
    may = F.coalesce(may_set, F.lit(False))
    # what the row leaves behind: something, nothing, or (null) what was there before
    leaves = F.when((F.col(verb) == sets) & may, True).when(F.col(verb) == takes_back, False)
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    stands = F.coalesce(F.last(leaves, ignorenulls=True).over(w), F.lit(False))
    refusal = F.when(F.col(verb) == sets, F.when(~may, why)).when(F.col(verb) == takes_back, F.when(~stands, "nothing to remove")).otherwise("unknown verb")
    return verbs.withColumn("refusal", refusal).withColumn("accepted", F.col("refusal").isNull())


def standing(judged: DataFrame, keys: list[str], order: list[str], verb: str, sets: str) -> DataFrame:
    """What stands after all accepted verbs of ruled(): each key's last accepted row, if it sets."""
    last = judged.filter("accepted").groupBy(*keys).agg(F.max_by(F.struct(*[c for c in judged.columns if c not in (*keys, "accepted", "refusal")]), F.struct(*order)).alias("__row"))
    return last.select(*keys, "__row.*").filter(F.col(verb) == sets)


def push_ledger(verbs: DataFrame, people: DataFrame) -> DataFrame:
    """Approvals for a push: verbs (work, name, verb approve or unapprove, at, seq) judged against the work's stored people (work, name); close: stored names that hold the refused one, without regard to case."""
    known = people.select(F.col("work").alias("__w"), F.col("name").alias("__n"), F.lit(True).alias("__known")).distinct()
    met = verbs.join(known, _same({"work": "__w", "name": "__n"}), "left").drop("__w", "__n")
    judged = ruled(met, ["work", "name"], ["at", "seq"], "verb", "approve", "unapprove", F.col("__known"), "not a stored person").drop("__known")
    lost = judged.filter((F.col("verb") == "approve") & ~F.col("accepted")).select("work", "name").distinct()
    near = lost.join(people.select(F.col("work").alias("__w"), F.col("name").alias("__near")).distinct(), F.col("work") == F.col("__w")).filter(F.contains(F.lower("__near"), F.lower("name")))
    close = near.groupBy(F.col("work").alias("__cw"), F.col("name").alias("__cn")).agg(F.sort_array(F.collect_set("__near")).alias("close"))
    return judged.join(close, _same({"work": "__cw", "name": "__cn"}), "left").drop("__cw", "__cn").withColumn("close", F.when(~F.col("accepted"), F.col("close")))


def rejected_types(verbs: DataFrame) -> DataFrame:
    """Rejections of type strings: verbs (type, verb reject or unreject, reason, at, seq), trimmed; a rejection needs a type and a reason that are not blank."""
    tidy = verbs.withColumns({c: F.trim(F.coalesce(c, F.lit(""))) for c in ("type", "reason")})
    return ruled(tidy, ["type"], ["at", "seq"], "verb", "reject", "unreject", (F.col("type") != "") & (F.col("reason") != ""), "a rejection needs a type and a reason")


def annotated(proposals: DataFrame, rejected: DataFrame, key: str = "type") -> DataFrame:
    """proposals with rejected_reason: what a rejection of the same trimmed type says, null where none stands. rejected: type, reason, a row each."""
    said = rejected.select(F.col("type").alias("__type"), F.col("reason").alias("rejected_reason"))
    return proposals.join(said, F.trim(F.col(key)) == F.col("__type"), "left").drop("__type")


def judge_records(claims: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Training records of judged claims: each claim with its disposition, whether it was judged, its chapter's index and the window around its quote; window is empty where the quote is not found again.

    claims: work, pos, shipped, from, to, type, original_type, note, p, chapter (its label), quote; labels: work, pos,
    label, index, of which the last of a label counts; texts: work, index, text. The chapter's text is found by its
    label's index, in the claim's own work alone.
    """
    index = labels.filter("label <> ''").groupBy(F.col("work").alias("__w"), "label").agg(F.max_by("index", "pos").alias("__index"))
    own = claims.join(index, (F.col("work") == F.col("__w")) & (F.col("chapter") == F.col("label")), "left").drop("__w", "label")
    held = texts.select(F.col("work").alias("__w"), F.col("index").alias("__i"), F.col("text").alias("__text"))
    met = own.join(held, (F.col("work") == F.col("__w")) & (F.col("__index") == F.col("__i")), "left")
    done = scores.disposition(F.col("shipped"), F.col("note"), F.col("original_type"), F.col("type"))
    return met.select(*claims.columns, F.col("__index").alias("chapter_index"), done.alias("disposition"), F.col("p").isNotNull().alias("judged"), evidence.evidence_window(F.col("quote"), F.col("__text")).alias("window"))


def judge_counters(claims: DataFrame, quotes: DataFrame) -> DataFrame:
    """The counters of a harvest of judge records, one row a work.

    claims: work, shipped, disposition, p, window; quotes: work, gate, p, of triggers. records: all claims; draws: those
    that were judged; a row for each disposition, rebuilt windows and empty ones; decisions: trigger quotes that the
    decision gate itself judged, the only ones that become records; fallback and unjudged ones are counted as left out.
    """
    c, some = F.col, F.coalesce(F.col("window"), F.lit("")) != ""
    zero = [F.lit(0).cast("long").alias(n) for n in ("decisions", "left_out_fallback", "left_out_unjudged")]
    own = claims.groupBy("work").agg(F.count(F.lit(1)).alias("records"), F.count("p").alias("draws"), *(F.count_if(c("disposition") == d).alias(d) for d in ("shipped", "downgraded", "dropped")), F.count_if(some).alias("windows"), F.count_if(~some).alias("windows_empty"))
    judged = (c("gate") == "decision") & c("p").isNotNull()
    none = [F.lit(0).cast("long").alias(n) for n in ("records", "draws", "shipped", "downgraded", "dropped", "windows", "windows_empty")]
    said = F.coalesce(judged, F.lit(False))
    theirs = quotes.groupBy("work").agg(F.count_if(said).alias("decisions"), F.count_if(~said & (c("gate") == "fallback")).alias("left_out_fallback"), F.count_if(~said & ~F.coalesce(c("gate") == "fallback", F.lit(False))).alias("left_out_unjudged"))
    both = own.select("*", *zero).unionByName(theirs.select("work", *none, "decisions", "left_out_fallback", "left_out_unjudged"))
    return both.groupBy("work").agg(*(F.sum(n).alias(n) for n in both.columns if n != "work"))


def gold(queue: DataFrame, remote: dict[str, DataFrame]) -> DataFrame:
    """source, item, verdict, labeller, decided_at: rulings of the labelling queue (id, label, labelled_by, labelled_at) and of remote tables by name (id, status, decided_at, reviewed_at, labelled_at), of which only confirmed and rejected rows are rulings. The first time that is set counts."""
    own = queue.filter("label IS NOT NULL").select(F.lit("uncertainty_queue").alias("source"), F.col("id").cast("string").alias("item"), F.col("label").alias("verdict"), F.col("labelled_by").alias("labeller"), F.col("labelled_at").alias("decided_at"))
    for name, rows in remote.items():
        own = own.unionByName(rows.filter("status IN ('confirmed', 'rejected')").select(F.lit(f"remote:{name}").alias("source"), F.col("id").cast("string").alias("item"), F.col("status").alias("verdict"), F.lit(None).cast("string").alias("labeller"), F.coalesce("decided_at", "reviewed_at", "labelled_at").alias("decided_at")))
    return own


def reconciled(artefacts: DataFrame, harvested: DataFrame, keys: list[str]) -> DataFrame:
    """keys, in_artefacts, harvested, verdict: what artefacts hold (keys, n) against what was harvested (keys, n): PASS where they agree, FAIL elsewhere, a missing side counting as 0."""
    a = artefacts.select(*keys, F.col("n").alias("in_artefacts"), F.lit(0).cast("long").alias("harvested"))
    b = harvested.select(*keys, F.lit(0).cast("long").alias("in_artefacts"), F.col("n").alias("harvested"))
    out = a.unionByName(b).groupBy(*keys).agg(F.sum("in_artefacts").alias("in_artefacts"), F.sum("harvested").alias("harvested"))
    return out.withColumn("verdict", F.when(F.col("in_artefacts") == F.col("harvested"), "PASS").otherwise("FAIL"))


def roster_report(stored: DataFrame, minors: DataFrame, previews: DataFrame, work: str) -> DataFrame:
    """work, stored, minors, roster, missing, extra, verdict: whether stored and minor names (work, name) together are a preview's roster (work, name): PASS without missing and extra ones. A name in both stores counts once."""
    ours = stored.select(work, "name").union(minors.select(work, "name")).distinct()
    theirs = previews.select(work, "name").distinct()

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(work).agg(F.count(F.lit(1)).alias(name))

    parts = [counted(stored.select(work, "name").distinct(), "stored"), counted(minors.select(work, "name").distinct(), "minors"), counted(theirs, "roster"), counted(anti(theirs, ours, [work, "name"]), "missing"), counted(anti(ours, theirs, [work, "name"]), "extra")]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    out = every.groupBy(work).agg(*(F.coalesce(F.max(n), F.lit(0).cast("long")).alias(n) for n in ("stored", "minors", "roster", "missing", "extra")))
    return out.withColumn("verdict", F.when((F.col("missing") == 0) & (F.col("extra") == 0), "PASS").otherwise("FAIL"))
