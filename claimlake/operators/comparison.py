"""Two runs of a work compared: names that changed their form, ends that nobody bears, entries that merge or split people. Null works compare with nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from .joins import anti


def _tokens(c: str) -> Column:
    return F.array_distinct(F.filter(F.split(c, " "), lambda t: t != ""))


def _inside(a: Column, b: Column) -> Column:
    return (F.size(F.array_except(a, b)) == 0) & (F.size(a) < F.size(b))


def form_flips(old: DataFrame, new: DataFrame, old_forms: DataFrame, new_forms: DataFrame, work: str) -> DataFrame:
    """work, old, new, reason: names that left one run and may have come back into the other under another form.

    old, new: work, name (normalised). *_forms: work, owner, form, pos: the forms of a run's entries; of several owners
    of a form the first by pos has it. Reasons: token-subset, the words of one are some of the other's; else
    alias-linked, the new run's entry of the new name has the old one as a form, or the other way round. Only names
    that share a word or a form are joined.
    """
    gone = anti(old.select(work, "name").distinct(), new, [work, "name"]).filter("name <> ''")
    come = anti(new.select(work, "name").distinct(), old, [work, "name"]).filter("name <> ''")
    a = gone.select(work, F.col("name").alias("old"), F.explode(_tokens("name")).alias("__t"))
    b = come.select(F.col(work).alias("__w"), F.col("name").alias("new"), F.explode(_tokens("name")).alias("__u"))
    shared = a.join(b, (F.col(work) == F.col("__w")) & (F.col("__t") == F.col("__u"))).select(work, "old", "new").distinct()
    x, y = _tokens("old"), _tokens("new")
    subsets = shared.filter(_inside(x, y) | _inside(y, x)).withColumn("rank", F.lit(0))

    def owned(forms: DataFrame) -> DataFrame:
        return forms.filter("form <> ''").groupBy(F.col(work).alias("__w"), F.col("form").alias("__form")).agg(F.min_by("owner", F.struct("pos", "owner")).alias("__owner"))

    c = come.select(F.col(work).alias("__cw"), F.col("name").alias("new"))
    forward = gone.select(work, F.col("name").alias("old")).join(owned(new_forms), (F.col(work) == F.col("__w")) & (F.col("old") == F.col("__form"))).join(c, (F.col(work) == F.col("__cw")) & (F.col("__owner") == F.col("new")))
    g = gone.select(F.col(work).alias("__gw"), F.col("name").alias("old"))
    back = come.select(work, F.col("name").alias("new")).join(owned(old_forms), (F.col(work) == F.col("__w")) & (F.col("new") == F.col("__form"))).join(g, (F.col(work) == F.col("__gw")) & (F.col("__owner") == F.col("old")))
    linked = forward.select(work, "old", "new").union(back.select(work, "old", "new")).distinct().withColumn("rank", F.lit(1))
    first = subsets.unionByName(linked).groupBy(work, "old", "new").agg(F.min("rank").alias("rank"))
    return first.select(work, "old", "new", F.when(F.col("rank") == 0, "token-subset").otherwise("alias-linked").alias("reason"))


def unresolved_ends(claims: DataFrame, forms: DataFrame, work: str, order: str) -> DataFrame:
    """work, claims, bad, names: a work's claims (from, to), those with an end that no form (work, form) bears, and such ends in order of first appearance, trimmed, each once. A missing end bears no name."""
    ends = claims.select(work, order, F.posexplode(F.array("from", "to")).alias("__end", "name")).withColumn("form", names.norm_name("name"))
    lost = anti(ends, forms.filter("form <> ''"), [work, "form"]).withColumn("name", F.trim(F.coalesce("name", F.lit(""))))
    each = lost.groupBy(F.col(work).alias("__w"), "name").agg(F.min(F.struct(order, "__end")).alias("__at"))
    listed = each.groupBy("__w").agg(F.transform(F.array_sort(F.collect_list(F.struct("__at", "name"))), lambda x: x["name"]).alias("names"))
    bad = lost.groupBy(F.col(work).alias("__b")).agg(F.count_distinct(order).alias("bad"))
    total = claims.groupBy(work).agg(F.count(F.lit(1)).alias("claims"))
    x = total.join(listed, F.col(work).eqNullSafe(F.col("__w")), "left").join(bad, F.col(work).eqNullSafe(F.col("__b")), "left")
    return x.select(work, "claims", F.coalesce("bad", F.lit(0).cast("long")).alias("bad"), F.coalesce("names", F.array().cast("array<string>")).alias("names"))


def _leads(c: Column) -> Column:
    """A name and what its first words spell."""
    words = F.split(c, " ")
    return F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_join(F.slice(words, 1, i), " "))


def claimed_entities(forms: DataFrame, entities: DataFrame, work: str) -> DataFrame:
    """work, entry, entity: labelled entities (work, entity, normalised) that an entry (work, entry, form) claims.

    A form claims the one entity that it equals, or of whose words it is the first ones, or the other way round; a form
    that fits two entities claims none. Joined by the spellings of first words, so only names that fit meet.
    """
    f = forms.filter("form <> ''").select(work, "entry", "form").distinct()
    e = entities.filter("entity <> ''").select(F.col(work).alias("__w"), "entity").distinct()
    longer = f.select(work, "form", F.explode(_leads(F.col("form"))).alias("__lead")).distinct().join(e, (F.col(work) == F.col("__w")) & (F.col("__lead") == F.col("entity"))).select(work, "form", "entity")
    shorter = e.select("__w", "entity", F.explode(_leads(F.col("entity"))).alias("__lead")).join(f.select(work, "form").distinct(), (F.col(work) == F.col("__w")) & (F.col("__lead") == F.col("form"))).select(work, "form", "entity")
    fits = longer.union(shorter).distinct().groupBy(work, "form").agg(F.min("entity").alias("entity"), F.count(F.lit(1)).alias("__n")).filter("__n = 1").select(F.col(work).alias("__fw"), F.col("form").alias("__f"), "entity")
    return f.join(fits, (F.col(work) == F.col("__fw")) & (F.col("form") == F.col("__f"))).select(work, "entry", "entity").distinct()


def identity_indicators(forms: DataFrame, entities: DataFrame, work: str) -> DataFrame:
    """work, kind, subject, others: merges, an entry that claims two labelled entities or more, and splits, an entity that two entries or more claim; the others in order."""
    claimed = claimed_entities(forms, entities, work)

    def several(kind: str, subject: str, other: str) -> DataFrame:
        g = claimed.groupBy(work, F.col(subject).cast("string").alias("subject")).agg(F.array_sort(F.collect_set(F.col(other).cast("string"))).alias("others"))
        return g.filter(F.size("others") >= 2).select(work, F.lit(kind).alias("kind"), "subject", "others")

    return several("merge", "entry", "entity").unionByName(several("split", "entity", "entry"))


def empty_evidence(claims: DataFrame, work: str) -> DataFrame:
    """work, family, empty, total: kept claims (type, evidence) without a quote, family types apart from others."""
    family = F.coalesce(names.norm("type").isin(*names.FAMILY), F.lit(False))
    return claims.groupBy(work, family.alias("family")).agg(F.count_if(F.trim(F.coalesce("evidence", F.lit(""))) == "").alias("empty"), F.count(F.lit(1)).alias("total"))


def prominence_changes(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, old, new: keys that both runs have, under another value; a null value is one of its own."""
    a = old.groupBy(*keys).agg(F.min(value).alias("old"))
    b = new.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.min(value).alias("new"))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return a.join(b, on).filter(~F.col("old").eqNullSafe(F.col("new"))).select(*keys, "old", "new")
