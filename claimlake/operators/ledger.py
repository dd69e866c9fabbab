"""What a store does with a run's claims: moves of keys, write plans, one claim a pair, states, comparisons, queues. Null keys are a key of their own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names
from .joins import RULED, replaceable


def _same(keys: list[str]) -> Column:
    return reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))


def rekeyed(df: DataFrame, group: str, key: str, moves: DataFrame) -> DataFrame:
    """Rows of a group move from the key old to the key new; the rows that stood under new before go, if the move is for two different keys.

    moves: group, old, new, one row for each old key; nulls in them move nothing.
    """
    go = moves.filter("old <> new").select(F.col(group).alias("__group"), "old", "new").filter("__group IS NOT NULL")
    kept = df.join(go, (F.col(group) == F.col("__group")) & (F.col(key) == F.col("new")), "left_anti")
    moved = kept.join(go, (F.col(group) == F.col("__group")) & (F.col(key) == F.col("old")), "left")
    return moved.withColumn(key, F.coalesce("new", key)).select(df.columns)


def write_plan(old: DataFrame, new: DataFrame, keys: list[str], within: list[str], made: Column, status: Column, ruled: tuple[str, ...] = RULED) -> DataFrame:
    """What replace_uncurated() would do to each group that new holds, without doing it: rows deleted, preserved, inserted, and not inserted because a row that stays holds their key."""
    deletable = replaceable(made, status, ruled)
    groups = new.select(*(F.col(k).alias(f"__{k}") for k in within)).distinct()
    here = old.withColumn("__gone", deletable).join(groups, _same(within), "left_semi")
    before = here.groupBy(*within).agg(F.count_if("__gone").alias("deleted"), F.count_if(~F.col("__gone")).alias("preserved"), F.lit(0).cast("long").alias("inserted"), F.lit(0).cast("long").alias("held_back"))
    firm = old.filter(~deletable).select(*(F.col(k).alias(f"__{k}") for k in keys), F.lit(True).alias("__held")).distinct()
    after = new.join(firm, _same(keys), "left").groupBy(*within).agg(F.lit(0).cast("long").alias("deleted"), F.lit(0).cast("long").alias("preserved"), F.count_if(F.col("__held").isNull()).alias("inserted"), F.count("__held").alias("held_back"))
    return before.unionByName(after).groupBy(*within).agg(*(F.sum(c).alias(c) for c in ("deleted", "preserved", "inserted", "held_back")))


def one_a_pair(df: DataFrame, keys: list[str], a: str, b: str, family: Column, evidence: str, order: list[Column]) -> DataFrame:
    """One claim for each unordered pair of a key: family claims before others, then more evidence (null: none), then order; how many claims stood for the pair, and how many of them were family claims."""
    pair = df.withColumn("pair", names.pair_key(F.col(a), F.col(b))).withColumn("__family", F.coalesce(family, F.lit(False)))
    rank = F.struct(~F.col("__family"), -F.coalesce(F.col(evidence), F.lit(0)), *order)
    best = pair.groupBy(*keys, "pair").agg(F.min_by(F.struct(*df.columns), rank).alias("__row"), F.count(F.lit(1)).alias("stood"), F.count_if("__family").alias("family_claims"))
    return best.select("__row.*", "pair", "stood", "family_claims")


def completeness(works: DataFrame, work: str, chapters: str, passages: str, vectors: str, parser: str, current: str) -> DataFrame:
    """state of each work from its counts (null: 0): absent, ingesting (text, no passages), text_complete, vectors_partial or complete; stale where another parser than current made it."""
    n = [F.coalesce(F.col(c), F.lit(0)) for c in (chapters, passages, vectors)]
    state = F.when((n[0] == 0) & (n[1] == 0), "absent").when(n[1] == 0, "ingesting").when(n[2] == 0, "text_complete").when(n[2] < n[1], "vectors_partial").otherwise("complete")
    return works.select(work, state.alias("state"), (F.col(parser).isNull() | (F.col(parser) != current)).alias("stale"))


def field_agreement(old: DataFrame, new: DataFrame, keys: list[str], field: str, item: str) -> DataFrame:
    """For each key and field: items shared, added and removed between two sides, and their Jaccard similarity.

    A side has a field if it has a row of it; a null item makes the field present and adds nothing. score: 1 where both
    sides are empty, null where a side lacks the field.
    """
    sides = old.select(*keys, field, item, F.lit(True).alias("__old")).union(new.select(*keys, field, item, F.lit(False)))
    each = sides.groupBy(*keys, field, item).agg(F.bool_or("__old").alias("__a"), F.bool_or(~F.col("__old")).alias("__b"))
    some, a, b = F.col(item).isNotNull(), F.col("__a"), F.col("__b")
    out = each.groupBy(*keys, field).agg(F.count_if(some & a & b).alias("shared"), F.count_if(some & b & ~a).alias("added"), F.count_if(some & a & ~b).alias("removed"), (F.bool_or(a) & F.bool_or(b)).alias("__both"))
    every = F.col("shared") + F.col("added") + F.col("removed")
    return out.select(*keys, field, "shared", "added", "removed", F.when(F.col("__both"), F.when(every == 0, 1.0).otherwise(F.col("shared") / every)).alias("score"))


def overall(scores: DataFrame, keys: list[str]) -> DataFrame:
    """The mean of a key's scores that are there, null without any."""
    return scores.groupBy(*keys).agg(F.avg("score").alias("overall"), F.count("score").alias("fields"))


def labelling_batch(df: DataFrame, work: str, number: str, p: str, family: Column, seed: str, most: int = 20) -> DataFrame:
    """A batch to label for each work: four uncertain items for each random decided one, most in all.

    Uncertain: a merge within 0.10 of 0.85, or a family claim within 0.10 of 0.30 or 0.70 inside that band; those nearest
    to a bar come first. The random ones are drawn by a hash of seed and number, so every run draws alike. Rows without a
    score take no part.
    """
    x, fam = F.col(p), F.coalesce(family, F.lit(False))
    far = F.round(F.when(fam, F.least(F.abs(x - 0.30), F.abs(x - 0.70))).otherwise(F.abs(x - 0.85)), 9)
    near = (far <= 0.10) & (~fam | x.between(0.30, 0.70))
    ranked = df.filter(x.isNotNull()).withColumn("reason", F.when(~near, "control").when(fam, "near_band_edge").otherwise("near_bar")).withColumn("__control", ~near)
    order = [F.when(near, far).otherwise(0.0), F.md5(F.concat(F.lit(seed), F.col(number).cast("string"))), F.col(number)]
    at = F.row_number().over(Window.partitionBy(work, "__control").orderBy(*order))
    top = ranked.withColumn("place", at).filter(F.col("place") <= most)
    return top.filter(F.col("place") <= F.when(F.col("__control"), most // 5).otherwise(most - most // 5)).drop("__control")


def within_tokens(df: DataFrame, keys: list[str], order: list[Column], tokens: str, budget: int) -> DataFrame:
    """The rows of each key in order up to the first that would pass the token budget. A key's rows are a roster, which one book bounds."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("used", F.sum(F.coalesce(F.col(tokens), F.lit(0))).over(w)).filter(F.col("used") <= budget)


def calibration(df: DataFrame, keys: list[str], score: str, label: Column, bars: list[float]) -> DataFrame:
    """How the scores of each label lie against each bar: rows, rows at or over it, and the median; a null score is counted apart."""
    some = F.col(score).isNotNull()
    each = df.withColumn("label", label).withColumn("bar", F.explode(F.array(*map(F.lit, bars))))
    return each.groupBy(*keys, "label", "bar").agg(F.count_if(some).alias("n"), F.count_if(F.col(score) >= F.col("bar")).alias("over"), F.count_if(~some).alias("unscored"), F.median(score).alias("median"))


def matched_outcomes(claims: DataFrame, outcomes: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Each claim with the last outcome under its keys, nulls equal nulls, and whether there was one."""
    rest = [c for c in outcomes.columns if c not in keys]
    last = outcomes.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__o")).select(*(F.col(k).alias(f"__{k}") for k in keys), "__o")
    return claims.join(last, _same(keys), "left").select(*claims.columns, F.col("__o").isNotNull().alias("joined"), *(F.col(f"__o.{c}").alias(c) for c in rest))
