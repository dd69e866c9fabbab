"""Operators and functions on nulls, ties, repeated keys and empty tables, with expected values worked out by hand."""

import json

import pytest
from pyspark.sql import functions as F

from claimlake.functions import evidence, names, scores
from claimlake.operators import joins, reduce
from claimlake.plans import imports
from claimlake.sources import previews


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_and_insert_with_repeated_and_null_keys(spark):
    old = spark.createDataFrame([(1, "x", 0), (None, "y", 0), (3, "z", 0)], "k int, v string, at int")
    new = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "n", 1), (4, "p", 2), (4, "q", 1)], "k int, v string, at int")
    assert rows(joins.upsert(old, new, ["k"], [F.col("at")])) == sorted([(1, "b", 2), (None, "n", 1), (3, "z", 0), (4, "p", 2)], key=str)
    assert rows(joins.insert_missing(old, new, ["k"], [F.col("at")])) == sorted([*map(tuple, old.collect()), (4, "q", 1)], key=str)
    assert rows(joins.upsert(old, new.limit(0), ["k"], [F.col("at")])) == rows(old)
    assert rows(joins.replace_wholesale(old, new, ["k"])) == sorted([(3, "z", 0), *map(tuple, new.collect())], key=str)


def test_curated_rows_stay(spark):
    """A null or empty status stays as a ruling does, and is not written beside."""
    old = spark.createDataFrame([(1, "a", "ai", "pending"), (1, "b", "ai", "rejected"), (1, "c", "human", "pending"), (2, "d", "ai", "pending"), (1, "e", None, "pending"), (1, "n", "ai", None), (1, "o", "ai", ""), (1, "p", "ai", "confirmed")], "w int, k string, made string, status string")
    new = spark.createDataFrame([(1, k, "ai", "new") for k in "abfnop"], old.schema)
    got = joins.replace_uncurated(old, new, ["w", "k"], ["w"], F.col("made") == "ai", F.col("status"))
    assert sorted(r.k + str(r.status) for r in got.collect()) == ["anew", "brejected", "cpending", "dpending", "epending", "fnew", "nNone", "o", "pconfirmed"]


def test_identity_rename_keeps_the_new_row(spark):
    df = spark.createDataFrame([("title:x", "n1", 1), ("w1", "n1", 2), ("title:x", "n2", 3), ("w2", "n1", 4)], "work string, name string, at int")
    assert rows(joins.renamed_identity(df, "work", ["name"], F.lit("title:x"), F.lit("w1"))) == [("w1", "n1", 2), ("w1", "n2", 3), ("w2", "n1", 4)]


def test_compared_with_null_keys(spark):
    a, b = spark.createDataFrame([(1,), (None,), (2,), (2,)], "k int"), spark.createDataFrame([(None,), (2,), (3,)], "k int")
    assert dict(rows(joins.compared(a, b, "k"))) == {1: "removed", None: "shared", 2: "shared", 3: "added"}


def test_freeze_rule(spark):
    data = [("a", 1, 0.2, False), ("a", 2, None, False), ("a", 3, None, True), ("a", 4, 0.9, False), ("b", 1, 0.5, None), ("b", 2, 0.6, False), (None, 1, 0.7, True), (None, 2, 0.8, True), ("c", 1, 0.1, False), ("c", 2, 0.3, True)]
    df = spark.createDataFrame(data, "k string, seq int, score double, firm boolean")
    got = {r.k: (r.settled_at, r.last_value, r.n_before) for r in reduce.frozen(df, ["k"], "seq", F.col("firm"), "score").collect()}
    assert got == {"a": (3, None, 3), "b": (None, 0.6, 2), None: (1, 0.7, 1), "c": (2, 0.3, 2)}
    assert reduce.frozen(df.limit(0), ["k"], "seq", F.col("firm"), "score").count() == 0


def test_summaries_with_zero_denominators(spark):
    df = spark.createDataFrame([(None, True), (None, False)], "p double, y boolean")
    (r,) = reduce.score_summary(df, "p", F.col("y"), [0.5]).collect()
    assert (r.tp, r.unanswered, r.accuracy, r.precision, r.recall) == (0, 2, 0.0, 0.0, 0.0)
    draws = spark.createDataFrame([("a", 0.9), ("a", 0.2), ("b", None), ("c", 0.71), ("c", 0.75), ("c", None)], "k string, p double")
    got = {r.k: (r.outcome, r.answers) for r in reduce.case_outcomes(draws, ["k"], "p", scores.band(F.col("p"), F.lit("parent"))).collect()}
    assert got == {"a": ("unstable", 2), "b": ("unanswered", 0), "c": ("keep", 2)}


def test_state_before_and_separation(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None), (5, "x")], "seq int, v string").withColumn("k", F.lit(1))
    assert [r.known for r in reduce.state_before(df, ["k"], "seq", "v").orderBy("seq").collect()] == [[], ["x"], ["x"], ["x", "y"], ["x", "y"]]
    s = spark.createDataFrame([(0.1, False), (0.5, True), (0.5, False), (0.9, True), (None, True)], "p double, y boolean").withColumn("k", F.lit(1))
    assert [(r.n, r.auc) for r in reduce.separation(s, ["k"], "p", F.col("y")).collect()] == [(4, 0.875)]


def test_names(spark):
    df = spark.createDataFrame([("  The  Ångström_Élan, Ltd. ",), (None,), ("An Apple",)], "n string")
    got = df.select(names.norm("n"), names.norm_name("n"), names.name_key("n"), names.work_key("n"), names.slug("n")).collect()
    assert tuple(got[0]) == ("the angstrom elan ltd", "ångström_élan, ltd.", "the angstrom elan ltd", "angstrom elan ltd", "the-ngstr-m-lan-ltd")
    assert tuple(got[1]) == ("", "", "", "", "unknown-book") and got[2][1] == "apple"
    pairs = [("Dr. Jon Ross", "Jon Ross", "yes"), ("Peter Sebeck", "Laura Sebeck", "no"), ("Ross", "Jon Ross", "ambiguous"), ("", "x", "ambiguous"), ("Mr. Jon (the old) Ross", "Jon Ross Smith", "yes")]
    df = spark.createDataFrame(pairs, "a string, b string, want string")
    assert all(r.got == r.want for r in df.withColumn("got", names.same_person(names.name_tokens("a"), names.name_tokens("b"))).collect())
    df = spark.createDataFrame([("Suarez, Daniel", "suarez"), ("Daniel Suarez", "suarez"), ("", ""), (None, "")], "n string, want string")
    assert all(r.got == r.want for r in df.withColumn("got", names.surname("n")).collect())
    df = spark.createDataFrame([("0-306-40615-2", "9780306406157"), ("978 0 306 40615 7", "9780306406157"), ("0-306-40615-3", None), ("080442957X", "9780804429573"), (None, None), ("x", None)], "n string, want string")
    assert all(r.got == r.want for r in df.withColumn("got", names.isbn13("n")).collect())
    df = spark.createDataFrame([("Daemon", "[Series 02] - Daemon", True), ("it", "with it", False), ("", "x", False), ("Daemon", "the daemon within", True)], "a string, b string, want boolean")
    assert all(r.got == r.want for r in df.withColumn("got", names.titles_match("a", "b")).collect())
    pair = spark.createDataFrame([("bo", "Al", "parent")], "a string, b string, k string").select(names.canonical_pair(F.col("a"), F.col("b"), F.col("k")).alias("p")).first().p
    assert tuple(pair) == ("Al", "bo", "child")


def test_evidence(spark):
    text = "One is here.  Two “went” home!\nThree stays? Four  ends. Five."
    df = spark.createDataFrame([(text, "Three stays? Four ends."), (text, 'Two "went"'), (text, "absent words here"), (None, "x"), (text, "")], "t string, q string")
    got = df.select(evidence.quote_span(F.col("q"), F.col("t")).alias("s"), evidence.evidence_window(F.col("q"), F.col("t")).alias("w"), evidence.quote_strength(F.col("q"), F.col("t")).alias("g")).collect()
    assert [tuple(r.s) if r.s else None for r in got] == [(2, 3), (1, 1), None, None, None]
    assert [r.w for r in got] == ["One is here. Two “went” home! Five.", "One is here. Three stays? Four  ends.", "", "", ""]
    assert [r.g for r in got] == ["exact", "dropped", "unverified", "dropped", "dropped"]
    many = spark.createDataFrame([("Word here. " * 20_000, "Word here.")], "t string, q string").select(evidence.quote_span(F.col("q"), F.col("t")).alias("s")).first().s
    assert tuple(many) == (0, 0)


@pytest.fixture
def artefacts(spark, tmp_path):
    claim = {"from": "Al", "to": "Bo", "type": "friend", "chapter": "1"}
    one = {
        "title": "A_Book", "author": "Me",
        "characters": [{"name": "Al", "unresolved_mentions": "the tall one"}, {"name": ""}],
        "minor_characters": [{"name": "Al", "unresolved_mentions": ["no"]}, {"name": "Cy", "unresolved_mentions": ["x", "x", "y"]}],
        "relationships": [claim | {"validation_p": 0.8, "validation_state": "validated", "validation_note": "downgraded"}, claim | {"type": "other", "validation_p": "0.9", "validation_state": "validated"}],
        "minor_sourced_relationships": [{"from": "Cy", "to": None, "type": "foe", "validation_p": 0.5, "validation_state": "rejected"}],
        "dropped_relationships": [claim | {"type": "foe", "validation_p": 0.2}, claim | {"type": "foe", "validation_p": 0.7}],
        "possible_merges": [{"name_a": "B", "name_b": "A", "p_yes": 0.5, "reason": "below"}, {"name_a": "A", "name_b": "B", "p_yes": 0.6}, {"name_a": "A", "name_b": None, "p_yes": 0.4}, {"name_a": "A", "name_b": "D", "p_yes": True}, {"name_a": "A", "name_b": "E", "p_yes": 0.9}],
    }
    (tmp_path / "one.json").write_text("﻿" + json.dumps(one), encoding="utf-8")
    (tmp_path / "two.json").write_text('{"minor_characters": []}', encoding="utf-8")
    return previews.scan(spark, str(tmp_path))


def test_import(artefacts):
    assert {r.work_id for r in artefacts.collect()} == {"title:a book|me", "title:two|"}
    assert {(r.name, r.list) for r in previews.people(artefacts).collect()} == {("Al", 0), ("Cy", 1)}
    assert {r.name for r in previews.stored_names(artefacts).collect()} == {"Al"}
    assert {(r["from"], r.type, r.state, r.score) for r in previews.dropped_claims(artefacts).collect()} == {("Cy", "foe", "rejected", 0.5), ("Al", "foe", "dropped", 0.2)}
    assert {(r.type, r.state, r.score) for r in previews.near_misses(artefacts).collect()} == {("friend", "downgraded", 0.8), ("other", "validated", None)}
    assert {(r.character, r.mention) for r in previews.mentions(artefacts).collect()} == {("Al", "the tall one"), ("Cy", "x"), ("Cy", "y")}
    assert {(r.name_a, r.name_b, r.state, r.score) for r in previews.merges(artefacts).collect()} == {("B", "A", "below", 0.5), ("A", None, "left_for_review", 0.4), ("A", "D", "left_for_review", None), ("A", "E", "left_for_review", 0.9)}
    assert {(r.kind, r.label, r.score) for r in previews.alerts(artefacts).collect()} == {("claim", "Cy → (unnamed)", 0.5), ("claim", "Al → Bo", 0.8), ("merge", "A ↔ B", 0.5), ("merge", "(unnamed) ↔ A", 0.4)}


def test_an_artefact_without_lists_of_people_is_an_error(spark):
    df = spark.createDataFrame([("{}", "bare.json")], "value string, file string")
    with pytest.raises(Exception, match="no list of characters"):
        previews.people(previews.parsed(df)).collect()
    odd = spark.createDataFrame([('{"characters": [{"name": "Al", "unresolved_mentions": 5}]}', "odd.json")], "value string, file string")
    with pytest.raises(Exception, match="no known shape"):
        previews.mentions(previews.parsed(odd)).collect()


def test_no_object_is_an_error(spark):
    bad = spark.createDataFrame([("[1]", "bad.json")], "value string, file string")
    with pytest.raises(Exception, match="bad.json"):
        previews.parsed(bad).collect()
    assert previews.alerts(previews.parsed(bad.limit(0))).count() == 0


def test_artefacts_are_read_once_for_claims_and_once_for_merges(spark):
    art = previews.parsed(spark.createDataFrame([("{}", "a.json")], "value string, file string"))

    def reads(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("from_json(")

    assert reads(previews.alerts(art)) == 2
    assert reads(previews.near_misses(art)) == reads(previews.merges(art)) == 1


def test_artefacts_gather_a_days_events_once(spark):
    """Ids and types alone are shuffled: whole claims and people were gathered in six lists before."""
    rows = [(8, 1, "view"), (3, 1, "click"), (8, 1, None), (None, 1, "view"), (4, 2, "signup")]
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string").withColumn("ts", F.lit("2024-01-05").cast("timestamp"))
    art = imports._artefacts(lambda _: events)
    assert art._jdf.queryExecution().optimizedPlan().toString().count("collect_list(") == 1
    one, two = art.orderBy("work_id").collect()
    assert (one.work_id, two.work_id) == ("u1-5", "u2-5")
    assert [[(c["from"], c.to, c.type, c.chapter, c.validation_state, c.validation_note) for c in one[k]] for k in previews.CLAIM_LISTS] == [[("n3", "n3", "click", "5", None, None)], [], [("n1", "n3", None, "5", "validated", None), ("n1", "n3", "view", "5", "validated", None)]]
    assert [p.name for p in one.characters] == [None, "n1"] and [p.name for p in one.minor_characters] == ["n3"] and one.possible_merges == []
    assert [(m.name_a, m.name_b) for m in two.possible_merges] == [("n0", "n1")] and [c["from"] for c in two.minor_sourced_relationships] == ["n4"]
