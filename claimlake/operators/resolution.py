"""Names and outputs resolved between stores and runs.

Every form is reduced by partial aggregates before it is joined, so that a form which a third of all rows share costs
one row. Null forms resolve to nothing; repeated rows count once; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ledger import _same


def through_aliases(links: DataFrame, forms: DataFrame, a: str, b: str) -> DataFrame:
    """Links with `from_key` and `to_key`: a form's own entry (rank 0) before an alias (rank 1), then the first `at`.

    `forms` holds form, rank, at and key. A link with an unresolved end, or whose ends are one key, is `skipped`.
    """
    best = forms.filter("form IS NOT NULL").groupBy("form").agg(F.min_by("key", F.struct("rank", "at", "key")).alias("key"))
    for end, name in ((a, "from_key"), (b, "to_key")):
        links = links.join(best.select(F.col("form").alias("__form"), F.col("key").alias(name)), F.col(end) == F.col("__form"), "left").drop("__form")
    return links.withColumn("skipped", F.coalesce(F.col("from_key") == F.col("to_key"), F.lit(True)))


def by_longest_prefix(forms: DataFrame, entries: DataFrame, form: str) -> DataFrame:
    """One row per distinct form with `entity` and `matched`: the form itself or its longest leading tokens that name entities.

    `entries` holds form and entity. If that longest match names more than one entity, or nothing matches, both are null.
    """
    named = entries.dropna(subset=["form", "entity"]).groupBy("form").agg(F.min("entity").alias("lo"), F.max("entity").alias("hi"))
    tokens = F.split(form, " ")
    heads = forms.select(form).distinct().select(form, F.posexplode_outer(F.transform(F.sequence(F.lit(1), F.size(tokens)), lambda n: F.array_join(F.slice(tokens, 1, n), " "))).alias("n", "head"))
    found = heads.join(named.withColumnRenamed("form", "head"), "head", "left")
    hit = F.when(F.col("lo").isNotNull(), F.struct("n", "head", "lo", "hi"))
    best = found.groupBy(form).agg(F.max(hit).alias("m"))
    one = F.col("m.lo") == F.col("m.hi")
    return best.select(form, F.when(one, F.col("m.lo")).alias("entity"), F.when(one, F.col("m.head")).alias("matched"))


def by_id_prefix(queries: DataFrame, works: DataFrame, prefix: str, work: str, least: int = 4) -> DataFrame:
    """One row per distinct prefix with the work whose id starts with it: null unless it is the only one, or under `least` characters.

    Ids are exploded only to the lengths that queries have, so that the join is on equal keys.
    """
    asked = queries.select(prefix).dropna().distinct()
    sizes = asked.select(F.length(prefix).alias("__size")).distinct().filter(F.col("__size") >= least)
    heads = works.select(work).dropna().distinct().join(F.broadcast(sizes), F.length(work) >= F.col("__size")).select(work, F.substring(F.col(work), F.lit(1), F.col("__size")).alias(prefix))
    only = heads.groupBy(prefix).agg(F.min(work).alias("lo"), F.max(work).alias("hi")).filter("lo = hi").select(prefix, F.col("lo").alias(work))
    return asked.join(only, prefix, "left")


def by_tiers(old: DataFrame, new: DataFrame, key: str, tiers: list[str]) -> DataFrame:
    """Pairs `old_<key>`, `new_<key>`, `tier`: for each column of `tiers` in turn, ids that share a value alone.

    A value matches if one id of each side holds it; an id with two partners in a tier abstains there. Matched ids
    leave before the next tier. No pairs are formed within a value: each side is reduced to its least and greatest id.
    """
    o, n = f"old_{key}", f"new_{key}"
    found = None
    for tier, form in enumerate(tiers):
        rest_old, rest_new = old, new
        if found is not None:
            rest_old = old.join(found.select(F.col(o).alias(key)), key, "left_anti")
            rest_new = new.join(found.select(F.col(n).alias(key)), key, "left_anti")
        sides = rest_old.select(F.col(form).alias("form"), F.col(key).alias("o"), F.lit(None).alias("n")).unionByName(rest_new.select(F.col(form).alias("form"), F.lit(None).alias("o"), F.col(key).alias("n")))
        alone = sides.filter("form IS NOT NULL").groupBy("form").agg(*[f(c).alias(f.__name__ + c) for f in (F.min, F.max) for c in ("o", "n")]).filter("mino = maxo AND minn = maxn")
        pairs = alone.groupBy("mino").agg(F.min("minn").alias("lo"), F.max("minn").alias("hi")).filter("lo = hi")
        pairs = pairs.groupBy("lo").agg(F.min("mino").alias("first"), F.max("mino").alias("last")).filter("first = last")
        pairs = pairs.select(F.col("first").alias(o), F.col("lo").alias(n), F.lit(tier).alias("tier"))
        found = pairs if found is None else found.unionByName(pairs)
    return found


def settled(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Each key of either side with what a stage does to its stored output: `written`, `reused` or `deleted`.

    Both sides hold one row per key; null keys meet null keys, and a null value equals a null value.
    """
    a = old.select(*keys, F.col(value).alias("__old"), F.lit(True).alias("__in_old"))
    b = new.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(value).alias("__new"), F.lit(True).alias("__in_new"))
    both = a.join(b, _same(keys), "full")
    action = F.when(F.col("__in_new").isNull(), "deleted").when(F.col("__in_old") & F.col("__old").eqNullSafe(F.col("__new")), "reused").otherwise("written")
    return both.select(*[F.coalesce(k, f"__{k}").alias(k) for k in keys], action.alias("action"))


def placed(fixture: DataFrame, places: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Fixture rows with `state`: the first of `places` that holds their key, or `absent`. Null keys are absent."""
    names = list(places)
    held = None
    for rank, name in enumerate(names):
        rows = places[name].select(*keys, F.lit(rank).alias("__rank"))
        held = rows if held is None else held.unionByName(rows)
    first = held.dropna(subset=keys).groupBy(*keys).agg(F.min("__rank").alias("__rank"))
    state = F.coalesce(F.get(F.array(*map(F.lit, names)), F.col("__rank")), F.lit("absent"))
    return fixture.join(first, keys, "left").withColumn("state", state).drop("__rank")


def new_names(df: DataFrame, keys: list[str], name: str, chapter: str) -> DataFrame:
    """For each key and chapter the number of names it is the first to hold. Null names and chapters hold nothing."""
    first = df.dropna(subset=[name, chapter]).groupBy(*keys, name).agg(F.min(chapter).alias(chapter))
    return first.groupBy(*keys, chapter).agg(F.count(F.lit(1)).alias("n_new"))


def split_of(df: DataFrame, splits: DataFrame, title: str, otherwise: str = "train") -> DataFrame:
    """Rows with `split`: that of their title, whatever its case (the least, where titles repeat), or `otherwise`."""
    one = splits.dropna(subset=[title]).groupBy(F.lower(title).alias("__title")).agg(F.min("split").alias("split"))
    return df.join(one, F.lower(df[title]) == F.col("__title"), "left").drop("__title").withColumn("split", F.coalesce("split", F.lit(otherwise)))


def deciles(df: DataFrame, keys: list[str], score: str, places: int = 4) -> DataFrame:
    """Nine deciles of the scores of each key, interpolated, as an array `deciles`, with `n`.

    Scores are rounded to `places` first and counted, so that one key's state holds at most 10 ** places + 1 values of
    the unit interval. Null and NaN scores take no part; a key without scores has no row.
    """
    kept = df.filter(F.col(score).isNotNull() & ~F.isnan(score)).groupBy(*keys, F.round(score, places).alias(score)).agg(F.count(F.lit(1)).alias("__n"))
    return kept.groupBy(*keys).agg(F.sum("__n").alias("n"), F.percentile(score, [i / 10 for i in range(1, 10)], F.col("__n")).alias("deciles"))
