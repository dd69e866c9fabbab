"""Reductions of observations to facts: windows, roll-ups, verdict rules. Null keys are a key of their own.

flips, runs and admitted cut the rows by ranges of key and order, so that a hot key lies in many pieces, and carry over
what the pieces before leave. spread_top keeps k rows of a group in each task before it shuffles. state_before sorts a
key's rows in one task: a book's, bounded by what one writer produces. Everything else aggregates partially.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by order; order must be total for a defined result."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("__row")).select("__row.*")


def frozen(df: DataFrame, keys: list[str], seq: str, settled: Column, value: str) -> DataFrame:
    """Freeze rule: a key's first settled row ends it; later rows are ignored.

    last_value: the value of the last row up to the settled one, null too; a settled row without a value keeps the one
    before it. n_before: rows up to the settled one. settled_at: null where nothing settled, and then all rows count.
    """
    marked = df.withColumn("__firm", F.coalesce(settled, F.lit(False)))
    ends = marked.filter("__firm").groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.min(seq).alias("settled_at"))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    before = marked.join(ends, same, "left").filter(F.col("settled_at").isNull() | (F.col(seq) <= F.col("settled_at")))
    counts = ~F.col("__firm") | F.col(value).isNotNull()
    return before.groupBy(*keys).agg(F.first("settled_at").alias("settled_at"), F.max_by(value, F.when(counts, F.col(seq))).alias("last_value"), F.count(F.lit(1)).alias("n_before"))


#: Rows that a key may have to be worked on in one piece; pieces that the rows of a table with larger keys are cut into by their order, and the rows that the cuts are told from.
TOGETHER, PIECES, CUT_ROWS = 1_000_000, 64, 4096


def pieced(df: DataFrame, keys: list[str], order: list[str], together: int | None = None) -> DataFrame:
    """df with __key (keys as one value, in which nulls are equal) and __piece, which grows with the order.

    Keys of up to together rows are one piece each; telling whether there are larger ones is a count that aggregates
    partially. The cuts are quantiles of the order among the CUT_ROWS rows with the smallest hashes of it, the same
    each time they are told. A key with a third of all rows lies in about a third of the pieces, wherever in the order
    it stands; rows of equal order share a piece. Cuts only share out the work: results do not depend on them.
    """
    keyed = df.withColumn("__key", F.struct(*keys))
    if keyed.groupBy("__key").count().filter(F.col("count") > (TOGETHER if together is None else together)).isEmpty():
        return keyed.withColumn("__piece", F.lit(1))
    at = F.struct(*order)
    few = df.select(*order).orderBy(F.xxhash64(*order), *order).limit(CUT_ROWS).agg(F.array_sort(F.collect_list(at)).alias("x"))
    places = F.sequence(F.lit(1), F.lit(PIECES - 1))
    cuts = few.select(F.filter(F.transform(places, lambda i: F.get("x", F.floor(i * F.size("x") / PIECES).cast("int"))), lambda c: c.isNotNull()).alias("cuts"))
    marked = keyed.withColumn("__cuts", cuts.scalar())
    # no lambda: the optimizer misses the columns inside one when it infers filters for a join of the rows with their ends
    return marked.withColumn("__piece", F.array_position(F.sort_array(F.array_append("__cuts", at)), at)).drop("__cuts")


WITHIN = ["__key", "__piece"]


def flips(df: DataFrame, keys: list[str], seq: str, verdict: str) -> DataFrame:
    """How often the verdict changes in order; a null verdict is no change, neither to it nor from it."""
    rows = pieced(df.select(*keys, seq, verdict), keys, [seq]).withColumn("__last", F.lag(verdict).over(Window.partitionBy(*WITHIN).orderBy(seq)))
    ends = rows.groupBy(*WITHIN).agg(F.count_if(F.col("__last") != F.col(verdict)).alias("__n"), F.count(F.lit(1)).alias("__rows"), F.min_by(verdict, seq).alias("__first"), F.max_by(verdict, seq).alias("__end"))
    across = F.lag("__end").over(Window.partitionBy("__key").orderBy("__piece")) != F.col("__first")
    total = ends.withColumn("__n", F.col("__n") + F.coalesce(across.cast("int"), F.lit(0))).groupBy("__key").agg(F.sum("__n").alias("n_flips"), F.sum("__rows").alias("n_rows"))
    return total.select("__key.*", "n_flips", "n_rows")


def runs(df: DataFrame, keys: list[str], seq: str, state: str) -> DataFrame:
    """Gaps and islands: one row for each stretch of equal states; every null is a stretch of its own."""
    w = Window.partitionBy(*WITHIN).orderBy(seq)
    new = F.when(F.row_number().over(w) > 1, F.coalesce((F.lag(state).over(w) != F.col(state)).cast("long"), F.lit(1))).otherwise(0)
    rows = pieced(df.select(*keys, seq, state), keys, [seq]).withColumn("__new", new)
    ends = rows.groupBy(*WITHIN).agg(F.sum("__new").alias("__n"), F.min_by(state, seq).alias("__first"), F.max_by(state, seq).alias("__end"))
    by = Window.partitionBy("__key").orderBy("__piece")
    ends = ends.withColumn("__start", F.coalesce((F.lag("__end").over(by) != F.col("__first")).cast("long"), F.lit(1)))
    ends = ends.select(*WITHIN, (F.sum(F.col("__start") + F.col("__n")).over(by) - F.col("__n")).alias("__base"))
    numbered = rows.withColumn("__upto", F.sum("__new").over(w)).join(ends, WITHIN).withColumn("island", F.col("__base") + F.col("__upto"))
    return numbered.groupBy("__key", "island").agg(F.first(state).alias(state), F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"), F.count(F.lit(1)).alias("n_rows")).select("__key.*", "island", state, "first_seq", "last_seq", "n_rows")


def admitted(df: DataFrame, pool: str, order: list[str], demand: str, budget: int) -> DataFrame:
    """Budget admission: rows in order while their running demand is within the pool's budget. Null demands count as 0."""
    rows = pieced(df, [pool], order)
    w = Window.partitionBy(*WITHIN).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("__key").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    need = F.coalesce(F.col(demand), F.lit(0))
    base = rows.groupBy(*WITHIN).agg(F.sum(need).alias("__n")).select(*WITHIN, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    running = rows.withColumn("running", F.sum(need).over(w)).join(base, WITHIN).withColumn("running", F.col("running") + F.col("__base"))
    return running.select(*df.columns, "running", (F.col("running") <= budget).alias("granted"))


def spread_top(df: DataFrame, keys: list[str], group: str, order: list[Column], k: int) -> DataFrame:
    """The k best rows of each key, taking each group's best before any group's second."""
    ranked = df.withColumn("__g", F.row_number().over(Window.partitionBy(*keys, group).orderBy(*order)))
    return ranked.filter(F.col("__g") <= k).withColumn("pick", F.row_number().over(Window.partitionBy(*keys).orderBy("__g", *order))).filter(F.col("pick") <= k).drop("__g")


def confusion(df: DataFrame, score: str, label: Column, thresholds: list[float]) -> DataFrame:
    """tp, fp, tn, fn at each threshold; rows without a score take no part."""
    hit = F.col(score) >= F.col("threshold")
    each = df.filter(F.col(score).isNotNull()).withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    return each.groupBy("threshold").agg(F.count_if(hit & label).alias("tp"), F.count_if(hit & ~label).alias("fp"), F.count_if(~hit & ~label).alias("tn"), F.count_if(~hit & label).alias("fn"))


def _share(n: Column, of: Column) -> Column:
    return F.when(of > 0, n / of).otherwise(0.0)


def score_summary(df: DataFrame, score: str, label: Column, thresholds: list[float]) -> DataFrame:
    """confusion() with accuracy, precision and recall, 0 where a denominator is; unanswered rows (null score) are counted beside."""
    c = F.col
    each = df.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    hit, some = c(score) >= c("threshold"), c(score).isNotNull()
    cells = {"tp": hit & label, "fp": hit & ~label, "tn": ~hit & ~label, "fn": ~hit & label}
    out = each.groupBy("threshold").agg(*(F.count_if(some & x).alias(k) for k, x in cells.items()), F.count_if(~some).alias("unanswered"))
    return out.select("*", _share(c("tp") + c("tn"), c("tp") + c("tn") + c("fp") + c("fn")).alias("accuracy"), _share(c("tp"), c("tp") + c("fp")).alias("precision"), _share(c("tp"), c("tp") + c("fn")).alias("recall"))


def headline(df: DataFrame, keys: list[str], outcome: str, expect: str) -> DataFrame:
    """Counts behind the four headline metrics: precision and recall of keep, exact outcomes, abstentions; middle, unstable and unanswered abstain."""
    o, e = F.col(outcome), F.col(expect)
    counts = {"cases": F.lit(True), "pred_keep": o == "keep", "exp_keep": e == "keep", "true_keep": (o == "keep") & (e == "keep"), "decided": o.isin("keep", "drop"), "exact": (o == e) & o.isin("keep", "drop"), "abstained": o.isin("middle", "unstable", "unanswered")}
    return df.groupBy(*keys).agg(*(F.count_if(x).alias(k) for k, x in counts.items()))


def case_outcomes(df: DataFrame, keys: list[str], p: str, band: Column) -> DataFrame:
    """The band that all answered draws of a case agree on, or unstable; unanswered without any; their median and spread."""
    x = df.withColumn("__band", F.when(F.col(p).isNotNull(), band)).groupBy(*keys).agg(F.min("__band").alias("__lo"), F.max("__band").alias("__hi"), F.median(p).alias("median"), (F.max(p) - F.min(p)).alias("spread"), F.count(p).alias("answers"))
    out = F.when(F.col("answers") == 0, "unanswered").when(F.col("__lo") == F.col("__hi"), F.col("__lo")).otherwise("unstable")
    return x.select(*keys, out.alias("outcome"), "median", "spread", "answers")


def state_before(df: DataFrame, keys: list[str], seq: str, value: str) -> DataFrame:
    """Each row with the distinct values of its key before it, in order of first appearance."""
    w = Window.partitionBy(*keys).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    first = F.row_number().over(Window.partitionBy(*keys, value).orderBy(seq)) == 1
    marked = df.withColumn("__new", F.when(first, F.col(value)))
    return marked.withColumn("known", F.collect_list("__new").over(w)).drop("__new")


def separation(df: DataFrame, keys: list[str], score: str, label: Column) -> DataFrame:
    """Rows with a score, deciles, and the area under the curve by rank sums over distinct scores; null where one class is missing.

    Rows are counted by score before the window, so it sorts distinct scores only.
    """
    by = df.filter(F.col(score).isNotNull()).groupBy(*keys, score).agg(F.count_if(label).alias("__p"), F.count_if(~label).alias("__n"))
    w = Window.partitionBy(*keys).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    under = F.coalesce(F.sum("__n").over(w), F.lit(0)) + F.col("__n") / 2
    each = by.withColumn("__area", F.col("__p") * under)
    p, n = F.sum("__p"), F.sum("__n")
    return each.groupBy(*keys).agg((p + n).alias("n"), F.when((p > 0) & (n > 0), F.sum("__area") / (p * n)).alias("auc"))


def recurrences(df: DataFrame, keys: list[str], chapter: str, seq: str) -> DataFrame:
    """occurrences, the distinct chapters in order of first appearance, and the first of them, for each key."""
    per = df.groupBy(*keys, chapter).agg(F.count(F.lit(1)).alias("__n"), F.min(seq).alias("__at"))
    seen = F.transform(F.array_sort(F.collect_list(F.struct("__at", chapter))), lambda x: x[chapter])
    return per.groupBy(*keys).agg(F.sum("__n").alias("occurrences"), seen.alias("chapters")).withColumn("first_chapter", F.get("chapters", F.lit(0)))
