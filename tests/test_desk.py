"""Rulings in order, refusals, annotations, gold and reconciliations: hand-worked cases and a plain replay."""

import random

import pytest
from pyspark.sql import functions as F

from claimlake.functions import names, scores
from claimlake.operators import desk, metrics

VERB = "work string, name string, verb string, at int, seq int"


def test_verbs_take_effect_in_order(spark):
    rnd = random.Random(2)
    people = {("w", "Ann Lee"), ("w", "Bo"), ("v", "Bo")}
    rows = [(rnd.choice("wv"), rnd.choice(["Ann Lee", "Bo", "lee", None]), rnd.choice(["approve", "unapprove", "look", None]), rnd.randint(0, 20), i) for i in range(120)]
    stands, want = {}, {}
    for w, n, verb, at, seq in sorted(rows, key=lambda r: r[3:]):
        if verb == "approve":
            want[seq] = None if (w, n) in people else "not a stored person"
        elif verb == "unapprove":
            want[seq] = None if (w, n) in stands else "nothing to remove"
        else:
            want[seq] = "unknown verb"
        if want[seq] is None:
            stands.pop((w, n), None)
            if verb == "approve":
                stands[w, n] = (at, seq)
    got = desk.push_ledger(spark.createDataFrame(rows, VERB).repartition(3), spark.createDataFrame(list(people), "work string, name string"))
    assert {r.seq: r.refusal for r in got.collect()} == want and {tuple(r.close) for r in got.filter("close IS NOT NULL").collect()} == {("Ann Lee",)}
    left = desk.standing(got.drop("close"), ["work", "name"], ["at", "seq"], "verb", "approve")
    assert {(r.work, r.name): (r.at, r.seq) for r in left.collect()} == stands


def test_rejections_need_reasons_and_annotate(spark):
    rows = [("mentor of", "reject", "too vague", 1, 0), ("  ", "reject", "x", 2, 0), ("foe", "reject", "  ", 3, 0), ("ally", "reject", "why", 4, 0), ("ally", "unreject", None, 5, 0), ("never", "unreject", None, 6, 0), ("mentor of ", "reject", "still vague", 7, 0)]
    judged = desk.rejected_types(spark.createDataFrame(rows, "type string, verb string, reason string, at int, seq int"))
    assert [r.accepted for r in judged.orderBy("at").collect()] == [True, False, False, True, True, False, True]
    rejected = desk.standing(judged, ["type"], ["at", "seq"], "verb", "reject")
    proposals = spark.createDataFrame([(1, " mentor of"), (2, "ally"), (3, None)], "id int, type string")
    assert {r.id: r.rejected_reason for r in desk.annotated(proposals, rejected).collect()} == {1: "still vague", 2: None, 3: None}


def test_harvest_counters(spark):
    claims = spark.createDataFrame([("w", True, "shipped", 0.9, "text"), ("w", True, "downgraded", None, ""), ("w", False, "dropped", 0.1, None), ("v", True, "shipped", 0.0, "t")], "work string, shipped boolean, disposition string, p double, window string")
    quotes = spark.createDataFrame([("w", "decision", 0.5), ("w", "decision", None), ("w", "fallback", 0.5), ("w", None, 0.5), ("u", "retrieval", None)], "work string, gate string, p double")
    got = {r.work: tuple(r)[1:] for r in desk.judge_counters(claims, quotes).collect()}
    assert got == {"w": (3, 2, 1, 1, 1, 1, 2, 1, 1, 2), "v": (1, 1, 1, 0, 0, 1, 0, 0, 0, 0), "u": (0, 0, 0, 0, 0, 0, 0, 0, 0, 1)}


def test_gold_and_reconciliation(spark):
    queue = spark.createDataFrame([(1, "yes", "me", "t1"), (2, None, None, None)], "id long, label string, labelled_by string, labelled_at string")
    remote = spark.createDataFrame([(7, "confirmed", None, "r", "l"), (8, "pending", "d", None, None), (9, "rejected", None, None, None)], "id long, status string, decided_at string, reviewed_at string, labelled_at string")
    assert sorted(map(str, map(tuple, desk.gold(queue, {"tropes": remote}).collect()))) == ["('remote:tropes', '7', 'confirmed', None, 'r')", "('remote:tropes', '9', 'rejected', None, None)", "('uncertainty_queue', '1', 'yes', 'me', 't1')"]
    a, b = spark.createDataFrame([("x", 3), ("y", 2)], "k string, n long"), spark.createDataFrame([("x", 3), ("z", 1)], "k string, n long")
    assert sorted(map(tuple, desk.reconciled(a, b, ["k"]).collect())) == [("x", 3, 3, "PASS"), ("y", 2, 0, "FAIL"), ("z", 0, 1, "FAIL")]
    n = "w string, name string"
    stored, minors, preview = spark.createDataFrame([("w", "a"), ("w", "b"), ("v", "a")], n), spark.createDataFrame([("w", "b"), ("w", "c"), ("v", "z")], n), spark.createDataFrame([("w", "a"), ("w", "b"), ("w", "c"), ("v", "a"), ("v", "q"), ("u", "a")], n)
    assert sorted(map(tuple, desk.roster_report(stored, minors, preview, "w").collect())) == [("u", 0, 0, 1, 1, 0, "FAIL"), ("v", 1, 1, 2, 1, 1, "FAIL"), ("w", 2, 2, 3, 0, 0, "PASS")]
    assert desk.reconciled(a.filter("false"), b.filter("false"), ["k"]).filter(F.lit(True)).count() == 0


def test_judge_records_take_their_window_from_the_claims_chapter(spark):
    text = "One here. Two here. The quoted line stands. Four here. Five here. Six here."
    claims = [("w", 1, True, "a", "b", "ally", None, None, 0.5, "Ch 1", "The quoted line stands."), ("w", 2, True, "a", "b", "ally", "parent", None, None, "Ch 1", "Not there."), ("w", 3, False, "a", "b", "ally", None, None, 0.1, "Ch 9", "The quoted line stands."), ("v", 4, True, "a", "b", "ally", None, " Downgrade", None, "Ch 1", "The quoted line stands.")]
    df = spark.createDataFrame(claims, "work string, pos int, shipped boolean, `from` string, `to` string, type string, original_type string, note string, p double, chapter string, quote string")
    labels = spark.createDataFrame([("w", 1, "Ch 1", 5), ("w", 2, "Ch 1", 7), ("w", 3, None, 8), ("v", 1, "Ch 1", 99)], "work string, pos int, label string, index int")
    texts = spark.createDataFrame([("w", 7, text), ("w", 5, "other"), ("v", 7, text)], "work string, index int, text string")
    got = {r.pos: (r.chapter_index, r.disposition, r.judged, r.window) for r in desk.judge_records(df, labels, texts).collect()}
    assert got == {1: (7, "shipped", True, "One here. Two here. Four here. Five here."), 2: (7, "downgraded", False, ""), 3: (None, "dropped", True, ""), 4: (99, "downgraded", False, "")}


def test_answers_of_judges(spark):
    df = spark.createDataFrame([(1, '{"noul": 0.25}'), (2, '{"probabilities": {"yes": 1, "no": 0}}'), (3, '{"noul": null, "probabilities": {"yes": 0}}')], "id int, j string").withColumn("v", F.parse_json("j"))
    assert [r[0] for r in df.orderBy("id").select(scores.yes_share(F.col("v"))).collect()] == [0.25, 1.0, 0.0]
    for bad in ("{}", '{"noul": true}', '{"noul": "0.5"}', '{"noul": 1.01}', '{"noul": -0.1}'):
        with pytest.raises(Exception, match="no score"):
            spark.range(1).select(scores.yes_share(F.parse_json(F.lit(bad)))).collect()
    cases = [
        ('{"probabilities": {"a": 0.2, "b": 0.7, "c": true, "d": "x"}}', {"a": 0.2, "b": 0.7}, "b"),
        ('{"probabilities": {}, "scores": {"z": 1}, "label": "y"}', {"z": 1.0}, "y"),
        ('{"choice": 5, "answer": "ok"}', None, "ok"),
        ('{"distribution": {"q": "n"}, "top_label": "t"}', None, "t"),
        ('{"distribution": {"b": 0.5, "a": 0.5}}', {"a": 0.5, "b": 0.5}, "a"),
        ("[1]", None, None),
    ]
    got = spark.createDataFrame([(i, j) for i, (j, *_) in enumerate(cases)], "id int, j string").select("id", scores.choice(F.parse_json("j")).alias("c")).orderBy("id").collect()
    for r, (_, shares, picked) in zip(got, cases, strict=True):
        assert (None if r.c.shares is None else {x.option: x.share for x in r.c.shares}) == shares and r.c.picked == picked, r


def test_aliases_and_chapter_order(spark):
    forms = {"Sebeck's wife": False, "Sebeck’s son": False, "the James' house": False, "wife": False, "Son": False, "Mrs. Sebeck": False, "the major": False, "The Narrator": False, "Pete Sebeck": True, "Trip": True, "Leonard Littleton": True, "": False, "Theodore": True, "Sonny": True}
    df = spark.createDataFrame([(k, v) for k, v in forms.items()] + [(None, False)], "form string, ok boolean")
    assert df.filter(names.valid_alias("form") != F.col("ok")).collect() == []
    labels = spark.createDataFrame([(x,) for x in ("10", "9", " 2", "b", "a", "-1", "", None, "1.5")], "c string")
    assert [r.c for r in labels.orderBy(names.chapter_order("c"), "c").collect()] == ["-1", " 2", "9", "10", None, "", "1.5", "a", "b"]


def test_metrics_of_nothing(spark):
    df = spark.createDataFrame([("k", "supports", "supports"), ("k", "adjacent", "supports"), ("k", "adjacent", None), ("k", "odd", "supports")], "k string, e string, g string")
    assert {(r.e, r.supports, r.no_verdict, r.n, r.accuracy, r.leakage) for r in metrics.class_confusion(df, ["k"], "e", "g").collect()} == {("supports", 1, 0, 1, 1.0, None), ("adjacent", 1, 1, 2, 0.0, 0.5)}
    tiers = spark.createDataFrame([("a", "ambiguous", True), ("b", "yes", None), ("c", None, False), ("c", "no", False)], "k string, v string, y boolean")
    assert {(r.k, r.decided_share, r.ambiguous_share, r.accuracy) for r in metrics.decided_tiers(tiers, ["k"], "v", F.col("y")).collect()} == {("a", 0.0, 1.0, 0.0), ("c", 0.5, 0.5, 1.0)}
