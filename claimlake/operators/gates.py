"""What lets claims through: staging, breakers, reserves of a budget, dominance, checks. Null keys are a key of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names


def staging_key(kind: Column, name: Column, catalog: Column) -> Column:
    """The key under which a claim is staged: a trope's catalog id or else its tidy name, a trigger's warning; any other kind is an error."""
    trope = F.when(F.coalesce(catalog, F.lit("")) != "", F.concat(F.lit("trope:id:"), catalog)).otherwise(F.concat(F.lit("trope:name:"), names.tidy_title(name)))
    trigger = F.concat(F.lit("trigger:"), F.lower(F.trim(F.coalesce(name, F.lit("")))))
    return F.when(kind == "trope", trope).when(kind == "trigger", trigger).otherwise(F.raise_error(F.concat(F.lit("claims of this kind are never staged: "), F.coalesce(kind, F.lit("?")))))


def folded(df: DataFrame, work: str, name: str, catalog: str) -> DataFrame:
    """df with the catalog id of rows that lack one, where the work's rows of the same tidy name have exactly one."""
    tidy = names.tidy_title(F.col(name))
    known = df.filter(F.coalesce(F.col(catalog), F.lit("")) != "").groupBy(F.col(work).alias("__work"), tidy.alias("__name")).agg(F.min(catalog).alias("__low"), F.max(catalog).alias("__high")).filter("__low = __high")
    out = df.join(known, F.col(work).eqNullSafe(F.col("__work")) & (tidy == F.col("__name")), "left")
    return out.withColumn(catalog, F.coalesce(F.nullif(catalog, F.lit("")), "__low")).select(df.columns)


def staged(df: DataFrame, keys: list[str], work: str, run: str, independent: Column, firm: Column, after: int = 3, runs: DataFrame | None = None) -> DataFrame:
    """Every time that a claim was staged, and what came of it: promoted, expired or staged.

    A sighting is a claim's row in an independent run; dependent runs are neither sightings nor absences. firm: what
    makes a sighting stand by itself (support, evidence), null if nothing does. A firm sighting ships without being
    staged. A weak one stages the claim, and the next sighting promotes it (via its firm, or persistence), unless so
    many independent runs of the work passed without the claim: then it has expired, and a later weak sighting stages
    it anew. A promoted claim stays so for good. runs: the work's runs (work, run, all independent), where some may
    have seen nothing; else the runs are those of df. sightings and last_run: from the staging one on, all that follow
    a promotion. Rows are counted by run first, so no window holds more than a work's runs.
    """
    own = df.filter(F.coalesce(independent, F.lit(False)))
    every = (own if runs is None else runs).select(F.col(work).alias("__work"), F.col(run).alias("__run")).distinct()
    by_run = Window.partitionBy("__work").orderBy("__run")
    every = every.withColumn("__at", F.row_number().over(by_run)).withColumn("__done", F.count(F.lit(1)).over(Window.partitionBy("__work")))
    seen = own.groupBy(*keys, run).agg(F.max(firm).alias("__firm")).join(every, F.col(work).eqNullSafe(F.col("__work")) & (F.col(run) == F.col("__run")))
    w = Window.partitionBy(*keys).orderBy("__at")
    gap, then = F.lead("__at").over(w) - F.col("__at"), F.lead("__firm").over(w)
    on = w.rowsBetween(0, Window.unboundedFollowing)
    x = seen.withColumns({"__gap": gap, "__then": then, "__n": F.count(F.lit(1)).over(on), "__end": F.max(run).over(on)})
    weak = F.col("__firm").isNull()
    x = x.withColumn("__up", weak & F.coalesce(F.col("__gap") <= after, F.lit(False)))
    x = x.withColumn("__first", F.min(F.when(F.col("__up"), F.col("__at"))).over(Window.partitionBy(*keys)))
    x = x.filter(weak & (F.col("__first").isNull() | (F.col("__at") <= F.col("__first"))))
    gone = F.coalesce(F.col("__gap") > after, F.col("__done") - F.col("__at") >= after)
    up = F.col("__up")
    return x.select(
        *keys,
        F.col(run).alias("first_run"),
        F.when(up, F.col("__end")).otherwise(F.col(run)).alias("last_run"),
        F.when(up, F.col("__n")).otherwise(1).alias("sightings"),
        F.when(up, "promoted").when(gone, "expired").otherwise("staged").alias("state"),
        F.when(up, F.coalesce("__then", F.lit("persistence"))).alias("via"),
    )


def staging_account(entries: DataFrame, recorded: DataFrame, keys: list[str], counter: str) -> DataFrame:
    """The store's own counter of claims ever staged against the entries in each state; unaccounted is what the entries do not explain, and should be 0."""
    c = F.col("state")
    states = entries.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(*(F.count_if(c == s).alias(s) for s in ("staged", "promoted", "expired")), F.lit(True).alias("__some"))
    both = recorded.groupBy(*keys).agg(F.sum(counter).alias("staged_ever")).join(states, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "full")
    n = {s: F.coalesce(F.col(s), F.lit(0)) for s in ("staged_ever", "staged", "promoted", "expired")}
    return both.select(*(F.when(F.col("__some"), F.coalesce(k, f"__{k}")).otherwise(F.col(k)).alias(k) for k in keys), *(x.alias(s) for s, x in n.items()), (n["staged_ever"] - n["staged"] - n["promoted"] - n["expired"]).alias("unaccounted"))


def breakers(df: DataFrame, keys: list[str], failed: Column, rate: float, least: int) -> DataFrame:
    """attempts, errors, and whether a key's breaker trips: errors are rate of the attempts or more, of least attempts or more."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("attempts"), F.count_if(failed).alias("errors"))
    return out.withColumn("tripped", (F.col("attempts") >= least) & (F.col("errors") >= rate * F.col("attempts")))


def reserved(df: DataFrame, pool: str, order: str, demand: str, reserve: str, budget: str) -> DataFrame:
    """What each consumer of a pool is granted: in order, none may take what is reserved for those after it.

    Consumers take D in all up to and with one of them, and at most its cap, the budget less the later reserves. As caps
    grow with the order, the sum granted is D plus the least of 0 and cap - D so far. One row for each consumer; a pool
    has few.
    """
    w = Window.partitionBy(pool).orderBy(order)
    upto, later = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(1, Window.unboundedFollowing)
    x = df.withColumn("__d", F.sum(demand).over(upto)).withColumn("__cap", F.greatest(F.lit(0), F.col(budget) - F.coalesce(F.sum(reserve).over(later), F.lit(0))))
    x = x.withColumn("__sum", F.col("__d") + F.least(F.lit(0), F.min(F.col("__cap") - F.col("__d")).over(upto)))
    given = F.col("__sum") - F.coalesce(F.lag("__sum").over(w), F.lit(0))
    return x.withColumn("granted", given).withColumn("denied", F.col(demand) - F.col("granted")).drop("__d", "__cap", "__sum")


def dominant(df: DataFrame, keys: list[str], readers: str, order: list[Column], least: int = 100, ratio: int = 20) -> DataFrame:
    """The one row of a key, or its first by readers if it has least of them and ratio times the second's; no row otherwise. Null readers are 0."""
    n = F.coalesce(F.col(readers), F.lit(0))
    w = Window.partitionBy(*keys).orderBy(n.desc(), *order)
    top = df.withColumn("__at", F.row_number().over(w)).filter("__at <= 2").withColumn("__next", F.lead(n).over(w))
    alone = F.col("__next").isNull()
    return top.filter((F.col("__at") == 1) & (alone | ((n >= least) & (n >= ratio * F.greatest(F.col("__next"), F.lit(0)))))).withColumn("dominance", ~alone).drop("__at", "__next")


def listed(df: DataFrame, keys: list[str], value: str, order: list[Column], most: int = 20) -> DataFrame:
    """The first values of each key by order, how many it has, and the line that tells of the rest; null values take no part."""
    some = df.filter(F.col(value).isNotNull())
    first = some.withColumn("__at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("__at") <= most)
    shown = first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("__at", value))), lambda x: x[value]).alias("shown"))
    total = some.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.count(F.lit(1)).alias("total"))
    rest = F.col("total") - most
    return shown.join(total, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]).select(*keys, "shown", "total", F.when(rest > 0, F.concat(F.lit("… and "), rest.cast("string"), F.lit(" more"))).alias("more"))


def agreement(df: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """Pairs of rows that two partitions of a key's rows put together: both, a alone counted with both, b likewise. Counted from the sizes of cells; no pairs are made."""

    def pairs(by: list[str], name: str) -> DataFrame:
        return df.groupBy(*keys, *by).agg(F.count(F.lit(1)).alias("n")).groupBy(*keys).agg(F.sum(F.expr("n * (n - 1) div 2")).alias(name))

    parts = [pairs([a, b], "pairs_both"), pairs([a], "pairs_a"), pairs([b], "pairs_b")]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    return every.groupBy(*keys).agg(*(F.max(c).alias(c) for c in ("pairs_both", "pairs_a", "pairs_b")))


def checks(df: DataFrame, signals: dict[str, Column]) -> DataFrame:
    """One row for each check over all rows: how many break it, and whether it holds; a null breaks it. One pass."""
    counts = df.agg(*(F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in signals.items()))
    rows = F.array(*(F.struct(F.lit(n).alias("signal"), F.col(n).alias("broken")) for n in signals))
    return counts.select(F.inline(rows)).withColumn("ok", F.col("broken") == 0)
