"""Scores, bands and the rules that read them, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import FAMILY

#: Family claims are kept from KEEP and dropped under DROP, others are kept from DROP; draws near an edge are repeated.
KEEP, DROP, MARGIN = 0.70, 0.30, 0.15
DRAWS, DRAWS_NEAR_EDGE = 3, 5
#: Fixed value: pairs scored from here on are merged without review.
MERGE_AT = 0.85


def recorded(c: Column) -> Column:
    """A score as recorded, a variant: numbers that are finite; null for anything else, numbers in strings too."""
    kind = F.schema_of_variant(c)
    x = F.try_variant_get(c, "$", "double")
    return F.when(kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)") & ~F.isnan(x) & (F.abs(x) < float("inf")), x)


def band(p: Column, kind: Column) -> Column:
    """keep, middle, drop, or unanswered for a null score."""
    family = kind.isin(*FAMILY)
    return F.when(p.isNull(), "unanswered").when(F.coalesce(family, F.lit(False)), F.when(p >= KEEP, "keep").when(p < DROP, "drop").otherwise("middle")).otherwise(F.when(p >= DROP, "keep").otherwise("drop"))


def draw_count(p: Column, kind: Column) -> Column:
    """Draws that a case gets by its first score: more within MARGIN of an edge of its band."""
    near = F.abs(p - DROP) <= MARGIN + 1e-9
    family = F.coalesce(kind.isin(*FAMILY), F.lit(False)) & (F.abs(p - KEEP) <= MARGIN + 1e-9)
    return F.when(near | family, DRAWS_NEAR_EDGE).otherwise(DRAWS)


def shipped_confirmed(state: Column, note: Column, kind: Column) -> Column:
    """Validated under its own type: neither downgraded, nor of type other without a note that keeps it."""
    ok = state.eqNullSafe("validated") & ~note.eqNullSafe("downgraded")
    return ok & ~(kind.eqNullSafe("other") & ~note.eqNullSafe("kept"))


def disposition(shipped: Column, note: Column, original: Column, kind: Column) -> Column:
    """downgraded, shipped or dropped."""
    low = F.lower(F.trim(F.coalesce(note, F.lit(""))))
    turned = low.isin("downgraded", "downgrade") | ((F.coalesce(original, F.lit("")) != "") & ~original.eqNullSafe(kind))
    return F.when(shipped & turned, "downgraded").when(shipped, "shipped").otherwise("dropped")


def claim_label(a: Column, b: Column) -> Column:
    """Both ends of a claim, (unnamed) for one that is null or empty."""
    shown = [F.coalesce(F.nullif(x, F.lit("")), F.lit("(unnamed)")) for x in (a, b)]
    return F.concat(shown[0], F.lit(" → "), shown[1])


def cosine(a: Column, b: Column) -> Column:
    """Of two arrays of numbers; 0 where one has no length."""

    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size).otherwise(0.0)


def frequency_band(share: Column) -> Column:
    """rare, occasional, frequent or pervasive."""
    return F.when(share < 0.06, "rare").when(share < 0.15, "occasional").when(share < 0.35, "frequent").otherwise("pervasive")


def peak_band(peak: Column) -> Column:
    """0 to 3 for a peak of 0, 1, 2 or 3, and 4 or 5."""
    return F.when(peak <= 0, 0).when(peak <= 1, 1).when(peak <= 3, 2).otherwise(3)


def role(point_of_view: Column, share: Column, subtype: Column) -> Column:
    """protagonist from 0.30 of the chapters or with a point of view, supporting from 0.10, else minor; an antagonist stays one unless minor."""
    rank = F.when(point_of_view | (share >= 0.30), "protagonist").when(share >= 0.10, "supporting").otherwise("minor")
    return F.when(subtype.eqNullSafe("antagonist") & (rank != "minor"), "antagonist").otherwise(rank)


def decision_pool(chapters: Column) -> Column:
    """Judge calls that a book gets: one a chapter, 50 to 250."""
    return F.least(F.lit(250), F.greatest(F.lit(50), chapters))


def resized_pool(pool: Column, spent: Column, census: Column, reserve: Column) -> Column:
    """The pool after a census of what is left to judge; it never shrinks."""
    wanted = spent + F.ceil(census * 1.05).cast("int") + reserve
    return F.greatest(pool, F.least(F.lit(250), F.greatest(F.lit(50), wanted)))


def support_floor(chapters: Column) -> Column:
    """Mentions under which a trope is gated: a twentieth of the chapters, 3 at least."""
    return F.greatest(F.lit(3).cast("long"), F.floor(chapters / 20))


def stale(last_seen: Column, as_of: Column, days: int = 180) -> Column:
    """Not seen for so many days; null dates are not stale."""
    return F.coalesce(F.datediff(as_of, last_seen) >= days, F.lit(False))


def yes_share(c: Column) -> Column:
    """The share of a judge's answer (a variant object): its noul, or else probabilities.yes; an error where that is missing, no finite number, or outside 0 to 1. A null answer is missing too."""
    noul = F.try_variant_get(c, "$.noul", "variant")
    said = F.coalesce(F.when(~F.is_variant_null(noul), noul), F.try_variant_get(c, "$.probabilities.yes", "variant"))
    p = recorded(said)
    good = p.isNotNull() & (p >= 0) & (p <= 1)
    return F.when(good, p).otherwise(F.raise_error(F.concat(F.lit("no score from 0 to 1: "), F.coalesce(F.to_json(said), F.lit("missing")))))


def choice(c: Column) -> Column:
    """(shares, picked) of a judge's choice (a variant object): the first of probabilities, distribution and scores that is an object with entries, its finite numbers alone, null without any; and the first of choice, label, top_label and answer that is text, or else the option with the largest share, the smaller name of equal ones."""
    maps = [F.filter(F.map_entries(F.try_variant_get(c, f"$.{k}", "map<string, variant>")), lambda e: F.lit(True)) for k in ("probabilities", "distribution", "scores")]
    raw = F.coalesce(*(F.when(F.size(m) > 0, m) for m in maps))
    shares = F.filter(F.transform(raw, lambda e: F.struct(e["key"].alias("option"), recorded(e["value"]).alias("share"))), lambda e: e["share"].isNotNull())
    some = F.when(F.size(shares) > 0, shares)
    texts = [F.when(F.schema_of_variant(F.try_variant_get(c, f"$.{k}", "variant")) == "STRING", F.try_variant_get(c, f"$.{k}", "string")) for k in ("choice", "label", "top_label", "answer")]
    best = F.get(F.array_sort(some, lambda a, b: F.when(a["share"] > b["share"], -1).when(a["share"] < b["share"], 1).when(a["option"] < b["option"], -1).otherwise(1)), F.lit(0))["option"]
    return F.struct(some.alias("shares"), F.coalesce(*texts, best).alias("picked"))
