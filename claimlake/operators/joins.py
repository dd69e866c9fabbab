"""Joins that claims need: nearest preceding row, table mutations, set algebra with provenance. Null keys are a key of their own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .reduce import WITHIN, pieced


def nearest_before(left: DataFrame, right: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """As-of join: each left row with the value of the last right row of its key at or before it that has one.

    Both sides go into windows over pieces of a key, so neither is broadcast, no pairs are made and a hot key is shared
    out; each piece takes over the last value of those before. Right rows come first where times are equal.
    """
    a = left.withColumn("__side", F.lit(1)).withColumn("__value", F.lit(None).cast(right.schema[value].dataType))
    b = right.select(key, at, F.col(value).alias("__value"), F.lit(0).alias("__side"))
    both = pieced(a.unionByName(b, allowMissingColumns=True), [key], [at, "__side"])
    w = Window.partitionBy(*WITHIN).orderBy(at, "__side").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("__key").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    ends = both.groupBy(*WITHIN).agg(F.max_by("__value", F.when(F.col("__value").isNotNull(), F.struct(at, "__side"))).alias("__end"))
    ends = ends.select(*WITHIN, F.last("__end", ignorenulls=True).over(before).alias("__carried"))
    own = both.withColumn("__own", F.last("__value", ignorenulls=True).over(w)).filter("__side = 1").join(ends, WITHIN)
    return own.select(*left.columns, F.coalesce("__own", "__carried").alias(f"before_{value}"))


def anti(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of df whose key other has not; nulls equal nulls."""
    known = other.select(*(F.col(k).alias(f"__{k}") for k in keys)).distinct()
    return df.join(known, reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys)), "left_anti")


def one_each(df: DataFrame, keys: list[str], order: list[Column] | None, last: bool) -> DataFrame:
    """One row of each key: its first or last by order (total, for a defined result), by partial aggregation. No order: df as it is, its keys must be distinct."""
    if not order:
        return df
    pick = (F.max_by if last else F.min_by)(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*keys).agg(pick.alias("__row")).select("__row.*")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """New rows replace old rows of the same key; of new rows with one key the last by order comes in."""
    new = one_each(new, keys, order, last=True)
    return anti(old, new, keys).unionByName(new)


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Old rows stay; new rows come in only under keys that old has not, of several with one key the first by order."""
    return old.unionByName(anti(one_each(new, keys, order, last=False), old, keys))


def replace_wholesale(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All old rows of a key that new holds go, and all new rows come in."""
    return anti(old, new, keys).unionByName(new)


#: What a person's ruling leaves in a row's status.
RULED = ("rejected", "confirmed")


def replaceable(made: Column, status: Column, ruled: tuple[str, ...] = RULED) -> Column:
    """Whether a new run may replace a row: made by the machine, with a status, and that no ruling. A null or empty status stays, as does what nothing is known of."""
    return F.coalesce(made & (status != "") & ~status.isin(*ruled), F.lit(False))


def replace_uncurated(old: DataFrame, new: DataFrame, keys: list[str], within: list[str], made: Column, status: Column, ruled: tuple[str, ...] = RULED) -> DataFrame:
    """The replaceable() rows of each group that new holds go; all others stay, and new rows never come in under the key of one that stays."""
    gone = replaceable(made, status, ruled)
    groups = new.select(*(F.col(k).alias(f"__{k}") for k in within)).distinct().withColumn("__hit", F.lit(True))
    marked = old.join(groups, reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in within)), "left")
    kept = marked.filter(F.col("__hit").isNull() | ~gone).select(old.columns)
    return kept.unionByName(anti(new, old.filter(~gone), keys))


def renamed_identity(df: DataFrame, id_col: str, keys: list[str], old: Column, new: Column) -> DataFrame:
    """Rows under an old identity move to the new one; where the new one holds the key already, its own row stays and the moved one goes."""
    moved = df.withColumn("__moved", F.coalesce(F.col(id_col) == old, F.lit(False))).withColumn(id_col, F.when(F.col("__moved"), new).otherwise(F.col(id_col)))
    pick = F.min_by(F.struct(*df.columns), F.col("__moved"))
    return moved.groupBy(id_col, *keys).agg(pick.alias("__row")).select("__row.*").select(df.columns)


def without_orphans(df: DataFrame, key: str, referring: list[DataFrame]) -> DataFrame:
    """Rows whose key some referring table holds."""
    return df.join(reduce(DataFrame.union, (r.select(key) for r in referring)).distinct(), key, "left_semi")


def compared(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Each key with whether it was added, removed or shared: one union and one aggregation."""
    sides = old.select(key, F.lit(True).alias("__a"), F.lit(False).alias("__b")).union(new.select(key, F.lit(False), F.lit(True)))
    seen = sides.groupBy(key).agg(F.bool_or("__a").alias("__a"), F.bool_or("__b").alias("__b"))
    return seen.select(key, F.when(F.col("__a") & F.col("__b"), "shared").when(F.col("__a"), "removed").otherwise("added").alias("state"))
