"""Rosters over chapters: who is known before each, under which aliases; extraction pairs; identities over runs. Null keys are a key of their own unless said otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names
from .clusters import cut


def _same(a: dict[str, str]) -> Column:
    return reduce(Column.__and__, (F.col(x).eqNullSafe(F.col(y)) for x, y in a.items()))


def entries(people: DataFrame, book: str, chapter: str, pos: str) -> DataFrame:
    """book, key, name, first (chapter, pos): a person for each normalised name, under the name first written. people: book, chapter (rising), pos in it, name. Empty names are nobody."""
    keyed = people.withColumn("key", names.norm_name("name")).filter("key <> ''")
    at = F.struct(F.col(chapter).alias("chapter"), F.col(pos).alias("pos"))
    return keyed.groupBy(book, "key").agg(F.min_by("name", at).alias("name"), F.min(at).alias("first"))


def alias_facts(people: DataFrame, book: str, chapter: str, pos: str) -> DataFrame:
    """book, key, alias, adopted, since (chapter, pos, nth): aliases of persons, each once, from where it was first said.

    An alias that is already somebody else's own name is not adopted: it stays an unresolved mention. It counts as
    already known if that name was written before, in an earlier chapter or earlier in this one; what comes later takes
    nothing back. Aliases equal to the person's name as first written say nothing, nor do empty ones. people: aliases
    beside the columns of entries(). Two joins on (book, name); no person is collected.
    """
    own = entries(people, book, chapter, pos)
    said = people.withColumn("key", names.norm_name("name")).filter("key <> ''").select(F.col(book).alias("__book"), F.col("key").alias("__key"), F.col(chapter).alias("__chapter"), F.col(pos).alias("__pos"), F.posexplode("aliases").alias("__nth", "alias"))
    said = said.withColumn("__alias", names.norm_name("alias")).filter("__alias <> ''")
    said = said.join(own.select(F.col(book).alias("__b"), F.col("key").alias("__k"), F.col("name").alias("__name")), _same({"__book": "__b", "__key": "__k"})).filter("alias <> __name")
    owner = own.select(F.col(book).alias("__ob"), F.col("key").alias("__ok"), F.col("first").alias("__since"))
    met = said.join(owner, _same({"__book": "__ob", "__alias": "__ok"}), "left")
    at = F.struct(F.col("__chapter").alias("chapter"), F.col("__pos").alias("pos"))
    taken = (F.col("__ok") != F.col("__key")) & (F.col("__since") <= at)
    facts = met.withColumn("adopted", ~F.coalesce(taken, F.lit(False))).withColumn("__at", F.struct(F.col("__chapter").alias("chapter"), F.col("__pos").alias("pos"), F.col("__nth").alias("nth")))
    return facts.groupBy(F.col("__book").alias(book), F.col("__key").alias("key"), "alias", "adopted").agg(F.min("__at").alias("since"))


def states_before(people: DataFrame, chapters: DataFrame, book: str, chapter: str, pos: str) -> DataFrame:
    """For each chapter (book, chapter) and person known before it: key, name, appearances, chapters, last_seen, aliases, unresolved, evidence, place.

    Folded from what each chapter adds: a person's sums run over the chapters of the book in a window of its own, so no
    task holds a book, only one person's chapters. aliases and unresolved in the order in which they were first said;
    evidence: the first that is not empty; place: order of first appearance, from 0. people: evidence beside the columns
    of alias_facts().
    """
    own = entries(people, book, chapter, pos)
    place = (F.row_number().over(Window.partitionBy(book).orderBy("first", "key")) - 1).alias("place")
    own = own.select(book, "key", "name", "first", place)
    keyed = people.withColumn("key", names.norm_name("name")).filter("key <> ''")
    told = F.when(F.coalesce(F.col("evidence"), F.lit("")) != "", F.col("evidence"))
    deltas = keyed.groupBy(book, "key", F.col(chapter).alias("__chapter")).agg(F.count(F.lit(1)).alias("__n"), F.min_by(told, F.when(told.isNotNull(), F.col(pos))).alias("__told"))
    said = alias_facts(people, book, chapter, pos).groupBy(F.col(book).alias("__b"), F.col("key").alias("__k"), F.col("since.chapter").alias("__c")).agg(
        F.sort_array(F.collect_list(F.when(F.col("adopted"), F.struct("since", "alias")))).alias("__aliases"), F.sort_array(F.collect_list(F.when(~F.col("adopted"), F.struct("since", "alias")))).alias("__open")
    )
    deltas = deltas.join(said, _same({book: "__b", "key": "__k", "__chapter": "__c"}), "left").select(book, "key", "__chapter", "__n", "__told", "__aliases", "__open", F.lit(1).alias("__side"))
    asked = chapters.select(F.col(book).alias("__book"), F.col(chapter).alias("__chapter")).distinct()
    met = asked.join(own.select(book, "key", F.col("first.chapter").alias("__from")), F.col("__book").eqNullSafe(F.col(book)) & (F.col("__from") < F.col("__chapter")))
    rows = deltas.unionByName(met.select(book, "key", "__chapter", F.lit(0).alias("__side")), allowMissingColumns=True)
    w = Window.partitionBy(book, "key").orderBy("__chapter", "__side").rowsBetween(Window.unboundedPreceding, -1)

    def listed(c: str) -> Column:
        return F.transform(F.flatten(F.collect_list(c).over(w)), lambda x: x["alias"])

    # a chapter's own row comes before what it adds
    x = rows.select(book, "key", "__chapter", "__side", F.sum("__n").over(w).alias("appearances"), F.count("__n").over(w).alias("chapters"), F.max(F.when(F.col("__side") == 1, F.col("__chapter"))).over(w).alias("last_seen"), listed("__aliases").alias("aliases"), listed("__open").alias("unresolved"), F.first("__told", ignorenulls=True).over(w).alias("evidence"))
    x = x.filter("__side = 0").withColumnsRenamed({book: "__b", "key": "__k"})
    return x.join(own, _same({"__b": book, "__k": "key"})).select(book, F.col("__chapter").alias(chapter), "key", "name", "appearances", "chapters", "last_seen", "aliases", "unresolved", "evidence", "place")


def extraction_pairs(chapters: DataFrame, states: DataFrame, claims: DataFrame, outcomes: DataFrame, book: str, chapter: str) -> DataFrame:
    """A training pair for each chapter (book, chapter, text): the roster before it as JSON in order of first appearance, its size, and how many of the chapter's claims an outcome is known of.

    states: states_before(). claims: book, chapter, from, to, type; outcomes: book, from, to, type, disposition, of
    which the last by disposition counts where one claim has several. text_source: corpus, or unavailable without text.
    One chapter's roster and claims are collected, never a book's.
    """
    shown = [c for c in states.columns if c not in (book, chapter, "place")]
    roster = states.groupBy(F.col(book).alias("__b"), F.col(chapter).alias("__c")).agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("place", *shown))), lambda x: F.struct(*(x[c].alias(c) for c in shown)))).alias("roster"), F.count(F.lit(1)).alias("roster_size"))
    known = outcomes.groupBy(*(F.col(c).alias(f"__{c}") for c in (book, "from", "to", "type"))).agg(F.max("disposition").alias("__d"))
    joined = claims.join(known, _same({c: f"__{c}" for c in (book, "from", "to", "type")}), "left").groupBy(F.col(book).alias("__jb"), F.col(chapter).alias("__jc")).agg(F.count("__d").alias("joined"), F.count_if(F.col("__d").isNull()).alias("unjoined"))
    x = chapters.join(roster, _same({book: "__b", chapter: "__c"}), "left").join(joined, _same({book: "__jb", chapter: "__jc"}), "left")
    zero = F.lit(0).cast("long")
    return x.select(book, chapter, "text", F.when(F.coalesce(F.col("text"), F.lit("")) != "", "corpus").otherwise("unavailable").alias("text_source"), F.coalesce("roster", F.lit("[]")).alias("roster"), *(F.coalesce(c, zero).alias(c) for c in ("roster_size", "joined", "unjoined")))


def canonical_names(seen: DataFrame, entity: list[str], form: str, n: str, run: str, suspect: Column | None = None, near: float = 0.8) -> DataFrame:
    """entity, form: the name that an entity goes by.

    Of the forms with at least near of the most appearances: the one with most words, then the longest, then the one seen
    last, then the smallest. Suspect rows have no vote. Rows are summed by form first; an entity has few forms.
    """
    votes = seen if suspect is None else seen.filter(~F.coalesce(suspect, F.lit(False)))
    each = votes.filter(F.col(form) != "").groupBy(*entity, form).agg(F.sum(n).alias("__n"), F.max(run).alias("__run"))
    top = F.max("__n").over(Window.partitionBy(*entity))
    close = each.withColumn("__top", top).filter(F.col("__n") >= near * F.col("__top"))
    words = F.size(F.split(F.trim(F.col(form)), r"\s+"))
    rank = F.struct((-words).alias("a"), (-F.length(form)).alias("b"), (-F.col("__run")).alias("c"), F.col(form).alias("d"))
    return close.groupBy(*entity).agg(F.min_by(form, rank).alias(form))


def minted(new: DataFrame, known: DataFrame, work: str, order: list[str]) -> DataFrame:
    """new with id: numbers that go on without a gap from the most that known (work, id) has of the work, in order."""
    base = known.groupBy(F.col(work).alias("__work")).agg(F.max("id").alias("__base"))
    nth = F.row_number().over(Window.partitionBy(work).orderBy(*order))
    return new.withColumn("__nth", nth).join(base, F.col(work).eqNullSafe(F.col("__work")), "left").withColumn("id", (F.coalesce("__base", F.lit(0)) + F.col("__nth")).cast("long")).drop("__nth", "__work", "__base")


def resolved(redirects: DataFrame, work: str) -> DataFrame:
    """work, id, final of every redirected id: where its chain of redirects (work, id, to) ends; null for a chain that runs in a circle.

    Every round replaces a target by its target's own, so a chain of n takes about log2 n rounds. A circle is told once
    targets have jumped further than there are redirects.
    """
    step = cut(redirects.select(work, "id", F.col("to").alias("final")).filter("final IS NOT NULL"))
    n, reach = step.count(), 1
    while True:
        onto = step.select(F.col(work).alias("__work"), F.col("id").alias("__id"), F.col("final").alias("__final"))
        new = cut(step.join(onto, F.col(work).eqNullSafe(F.col("__work")) & (F.col("final") == F.col("__id")), "left").select(work, "id", F.coalesce("__final", "final").alias("final"), F.col("__id").isNotNull().alias("moved")))
        if new.filter("moved").isEmpty():
            return new.select(work, "id", "final")
        reach *= 2
        if reach > 2 * n:  # what still moves never ends
            return new.select(work, "id", F.when(~F.col("moved"), F.col("final")).alias("final"))
        step = new.select(work, "id", "final")


def id_account(entities: DataFrame, retired: DataFrame, counters: DataFrame, work: str) -> DataFrame:
    """work, minted, active, split, merged, unaccounted: every id ever minted (counters: work, minted) against entities (work, id, status) and retired ids (work, id)."""
    have = entities.groupBy(F.col(work).alias("__w")).agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("active", "split")))
    gone = retired.groupBy(F.col(work).alias("__r")).agg(F.count_distinct("id").alias("merged"))
    x = counters.join(have, F.col(work).eqNullSafe(F.col("__w")), "left").join(gone, F.col(work).eqNullSafe(F.col("__r")), "left")
    n = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("active", "split", "merged")}
    return x.select(work, "minted", *(v.alias(k) for k, v in n.items()), (F.col("minted") - n["active"] - n["split"] - n["merged"]).alias("unaccounted"))
