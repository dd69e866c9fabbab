"""Who may be one person: tiers of two names, and the pairs of a roster that names alone nominate. Names are compared as names.name_tokens() gives them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..functions.names import let

#: Words before a name that say nothing of who it is.
CONTEXT = ("the", "late", "former", "young", "old", "poor", "dear")


def core(c: Column | str) -> Column:
    """A name's words without context words and titles before them, and without single letters between the first and the last."""
    low = F.lower(names._tidy(names._text(c)))
    bare = F.regexp_replace(low, rf"^(?:(?:{'|'.join(CONTEXT)}) )+(?=\S)", "")
    words = names.name_tokens(bare)
    return let(words, lambda w: F.filter(w, lambda x, i: (F.length(x) > 1) | (i == 0) | (i == F.size(w) - 1)))


def spelling_variant(a: Column, b: Column) -> Column:
    """Whether two different words may be spellings of one: the same first letter, four letters or more each, two edits apart at most."""
    return (a != b) & (F.left(a, F.lit(1)) == F.left(b, F.lit(1))) & (F.least(F.length(a), F.length(b)) >= 4) & (F.levenshtein(a, b) <= 2)


def merge_tier(a: Column, b: Column, together: Column | None = None, nicknames: Column | None = None) -> Column:
    """yes, no or ambiguous for two names of a work.

    yes: their core() is the same, or they share the last word and nicknames (a map from a short form to its name) makes
    the first words one. no: they stand together in a chapter (together), or share the last word under first words that
    are neither spellings nor initials of each other: relatives share a surname. A single word never decides for itself.
    An empty name is ambiguous.
    """
    apart = F.lit(False) if together is None else F.coalesce(together, F.lit(False))

    def known(w: Column) -> Column:
        return w if nicknames is None else F.coalesce(F.try_element_at(nicknames, w), w)

    def judged(x: Column) -> Column:
        p, q = x["p"], x["q"]
        first, other = F.get(p, F.lit(0)), F.get(q, F.lit(0))
        full = (F.size(p) >= 2) & (F.size(q) >= 2)
        family = full & (F.try_element_at(p, F.lit(-1)) == F.try_element_at(q, F.lit(-1)))
        initial = (F.least(F.length(first), F.length(other)) == 1) & (F.left(first, F.lit(1)) == F.left(other, F.lit(1)))
        same = (F.size(p) > 0) & ((p == q) | (family & (F.size(p) == 2) & (F.size(q) == 2) & (known(first) == known(other))))
        some = (F.size(p) > 0) & (F.size(q) > 0)
        return F.when(same, "yes").when(some & apart, "no").when(some & family & (first != other) & ~spelling_variant(first, other) & ~initial, "no").otherwise("ambiguous")

    return let(F.struct(core(a).alias("p"), core(b).alias("q")), judged)


def nominated(people: DataFrame, work: str, key: str) -> DataFrame:
    """work, a, b, signals: pairs of a work's persons (work, key: a normalised name) that their names nominate, a before b.

    shared_surname: the same last word under more words each; containment: one name is a word or words at an end of the
    other; title_form: one is a title and a surname, and the other bears that surname under another name. Joined by the
    last word, and by the first one for containment, so names that share neither never meet.
    """
    low = F.lower(names._tidy(names._text(key)))
    spelled = F.regexp_extract_all(low, F.lit("[a-z0-9']+"), F.lit(0))
    x = people.select(work, F.col(key).alias("k"), spelled.alias("w"), names.name_tokens(low).alias("bare")).filter("size(w) > 0 AND k <> ''").distinct()
    x = x.withColumns({"last": F.element_at("w", -1), "first": F.get("w", F.lit(0)), "titled": (F.size("w") > F.size("bare")) & (F.size("bare") == 1)})
    ends = x.select("*", F.explode(F.array_distinct(F.array("first", "last"))).alias("end"))
    l, r = (ends.select(*(F.col(c).alias(f"{s}_{c}") for c in (work, "k", "w", "last", "titled", "end"))) for s in "lr")
    met = l.join(r, (F.col(f"l_{work}") == F.col(f"r_{work}")) & (F.col("l_end") == F.col("r_end")) & (F.col("l_k") < F.col("r_k")))
    a, b = F.col("l_w"), F.col("r_w")
    surname = (F.col("l_last") == F.col("r_last")) & (F.size(a) > 1) & (F.size(b) > 1)

    def inside(s: Column, t: Column) -> Column:
        n, m = F.size(s), F.size(t)
        return (n < m) & ((F.slice(t, 1, n) == s) | (F.slice(t, m - n + 1, n) == s))

    titled = surname & (F.col("l_titled") != F.col("r_titled"))
    signals = F.filter(F.array(F.when(surname, F.lit("shared_surname")), F.when(inside(a, b) | inside(b, a), F.lit("containment")), F.when(titled, F.lit("title_form"))), lambda s: s.isNotNull())
    return met.select(F.col(f"l_{work}").alias(work), F.col("l_k").alias("a"), F.col("r_k").alias("b"), signals.alias("signals")).distinct().filter("size(signals) > 0")


def for_the_judge(pairs: DataFrame, tier: Column) -> DataFrame:
    """The nominated pairs that a judge is asked about: those that the tier (merge_tier over a and b) leaves ambiguous, and title forms; relatives who merely share a surname never are."""
    return pairs.withColumn("tier", tier).filter((F.col("tier") == "ambiguous") | ((F.col("tier") == "no") & F.array_contains("signals", "title_form")))
