"""Roster folds against a plain replay, extraction pairs, identities, comparisons of two runs: hand-worked cases."""

import json
import random

from pyspark.sql import functions as F

from claimlake.operators import comparison, roster

PEOPLE = "book string, chapter int, pos int, name string, aliases array<string>, evidence string"


def key(name):
    low = " ".join((name or "").lower().split())
    for article in ("the ", "a ", "an "):
        if low.startswith(article):
            return low[len(article) :]
    return low


def replay(rows):
    """States before each chapter, by folding chapter after chapter."""
    out, rosters = {}, {}
    for book, chapter in sorted({(r[0], r[1]) for r in rows}):
        known = rosters.setdefault(book, {})
        for place, (k, e) in enumerate(known.items()):
            out[book, chapter, k] = (e["name"], e["n"], len(e["chapters"]), max(e["chapters"]), tuple(e["aliases"]), tuple(e["open"]), e["evidence"], place)
        for _, _, _, name, aliases, evidence in sorted((r for r in rows if r[:2] == (book, chapter)), key=lambda r: r[2]):
            k = key(name)
            if not k:
                continue
            e = known.setdefault(k, {"name": name, "n": 0, "chapters": set(), "aliases": [], "open": [], "evidence": None})
            e["n"] += 1
            e["chapters"].add(chapter)
            for alias in aliases or []:
                if not alias or alias == e["name"] or not key(alias):
                    continue
                where = "open" if key(alias) in known and key(alias) != k else "aliases"
                if alias not in e[where]:
                    e[where].append(alias)
            e["evidence"] = e["evidence"] or evidence or None
    return out


def test_roster_folds_as_a_replay_does(spark):
    rnd = random.Random(7)
    pool = ["Ann", "The Ann", "ann", "Bo", "Cy Lee", "Lee", "", None, "Dr. No"]
    rows = [(rnd.choice(["x", "x", "x", "y"]), rnd.randint(1, 9), i, rnd.choice(pool), rnd.sample(["Ann", "Bo", "Lee", "Annie", "B.", "", "Cy Lee"], rnd.randint(0, 3)) if rnd.random() < 0.8 else None, rnd.choice(["said so", "", None])) for i in range(160)]
    df = spark.createDataFrame(rows, PEOPLE).repartition(4)
    got = {(r.book, r.chapter, r.key): (r.name, r.appearances, r.chapters, r.last_seen, tuple(r.aliases), tuple(r.unresolved), r.evidence, r.place) for r in roster.states_before(df, df.select("book", "chapter"), "book", "chapter", "pos").collect()}
    assert got == replay(rows)


def test_an_alias_that_is_anothers_name_is_not_adopted(spark):
    rows = [("b", 1, 1, "Sebeck", ["Detective"], None), ("b", 2, 1, "Ross", ["Sebeck", "Jon"], None), ("b", 2, 2, "Late", None, None), ("b", 3, 1, "Jon", None, None), ("b", 3, 2, "Ross", ["Late", "Jon"], None), ("b", 4, 1, "Jon", None, None)]
    df = spark.createDataFrame(rows, PEOPLE)
    facts = {(r.key, r.alias, r.adopted) for r in roster.alias_facts(df, "book", "chapter", "pos").collect()}
    # Jon was adopted before he was anybody; said again later, he is somebody
    assert facts == {("sebeck", "Detective", True), ("ross", "Sebeck", False), ("ross", "Jon", True), ("ross", "Late", False), ("ross", "Jon", False)}


def test_extraction_pairs(spark):
    people = spark.createDataFrame([("b", 1, 1, "Ann", ["A."], "e"), ("b", 2, 1, "Bo", None, None)], PEOPLE)
    chapters = spark.createDataFrame([("b", 1, "one"), ("b", 2, ""), ("b", 3, None), ("c", 1, "x")], "book string, chapter int, text string")
    claims = spark.createDataFrame([("b", 2, "Ann", "Bo", "ally"), ("b", 2, "Bo", None, "ally"), ("b", 3, "Ann", "Bo", "foe")], "book string, chapter int, `from` string, `to` string, type string")
    outcomes = spark.createDataFrame([("b", "Ann", "Bo", "ally", "shipped"), ("b", "Ann", "Bo", "ally", "dropped"), ("b", "Bo", None, "ally", "dropped"), ("c", "Ann", "Bo", "foe", "shipped")], "book string, `from` string, `to` string, type string, disposition string")
    got = {(r.book, r.chapter): r for r in roster.extraction_pairs(chapters, roster.states_before(people, chapters, "book", "chapter", "pos"), claims, outcomes, "book", "chapter").collect()}
    assert {k: (r.text_source, r.roster_size, r.joined, r.unjoined) for k, r in got.items()} == {("b", 1): ("corpus", 0, 0, 0), ("b", 2): ("unavailable", 1, 2, 0), ("b", 3): ("unavailable", 2, 0, 1), ("c", 1): ("corpus", 0, 0, 0)}
    assert json.loads(got["b", 1].roster) == [] and [(e["name"], e["aliases"], e["evidence"]) for e in json.loads(got["b", 2].roster)] == [("Ann", ["A."], "e")]
    assert [e["name"] for e in json.loads(got["b", 3].roster)] == ["Ann", "Bo"]


def test_canonical_names(spark):
    rows = [("e1", "Violet", 100, 3, False), ("e1", "Violet Sorrengail", 80, 2, False), ("e2", "Violet", 100, 3, False), ("e2", "Violet Sorrengail", 79, 2, False), ("e3", "Al", 5, 1, False), ("e3", "Bo", 5, 2, False), ("e4", "Sure", 1, 1, False), ("e4", "Doubtful Name", 50, 1, True), ("e5", "A B", 2, 1, None), ("e5", "A C", 1, 9, False), ("e5", "A C", 1, 1, False)]
    df = spark.createDataFrame(rows, "entity string, form string, n long, run int, suspect boolean")
    got = {r.entity: r.form for r in roster.canonical_names(df, ["entity"], "form", "n", "run", F.col("suspect")).collect()}
    assert got == {"e1": "Violet Sorrengail", "e2": "Violet", "e3": "Bo", "e4": "Sure", "e5": "A C"}


def test_every_minted_id_is_accounted_for(spark):
    rnd = random.Random(11)
    known, redirects, status, counters = [], [], {}, {}
    for run in range(4):
        new = [(rnd.choice("wv"), run * 100 + i) for i in range(rnd.randint(3, 8))]
        df = spark.createDataFrame(new, "work string, seen int")
        ids = spark.createDataFrame(known or [("none", 0)], "work string, id long")
        for r in roster.minted(df, ids, "work", ["seen"]).collect():
            known.append((r.work, r.id))
            status[r.work, r.id] = "active"
            counters[r.work] = max(counters.get(r.work, 0), r.id)
        for w in "wv":
            live = [i for (x, i), s in status.items() if x == w and s == "active"]
            if len(live) > 3:
                a, b = rnd.sample(live, 2)
                status[w, a] = "merged"
                redirects.append((w, a, b))
            if len(live) > 5:
                status[w, rnd.choice([i for i in live if status[w, i] == "active"])] = "split"
    for w in "wv":
        assert sorted(i for x, i in known if x == w) == list(range(1, counters[w] + 1))  # no gap
    final = {(w, a): b for w, a, b in redirects}

    def chase(w, i):
        while (w, i) in final:
            i = final[w, i]
        return i

    got = {(r.work, r.id): r.final for r in roster.resolved(spark.createDataFrame(redirects, "work string, id long, to long"), "work").collect()}
    assert got == {(w, a): chase(w, a) for w, a, _ in redirects}
    entities = spark.createDataFrame([(w, i, s) for (w, i), s in status.items() if s != "merged"], "work string, id long, status string")
    retired = spark.createDataFrame([(w, a) for w, a, _ in redirects], "work string, id long")
    minted = spark.createDataFrame([*counters.items(), ("lost", 2)], "work string, minted long")
    assert {r.work: r.unaccounted for r in roster.id_account(entities, retired, minted, "work").collect()} == {"w": 0, "v": 0, "lost": 2}


def test_chains_and_circles_of_redirects(spark):
    rows = [("w", i, i + 1) for i in range(1, 40)] + [("w", 100, 101), ("w", 101, 102), ("w", 102, 100), ("w", 99, 100), ("v", 1, 5), ("v", 6, None)]
    got = {(r.work, r.id): r.final for r in roster.resolved(spark.createDataFrame(rows, "work string, id long, to long"), "work").collect()}
    assert got == {**{("w", i): 40 for i in range(1, 40)}, ("w", 100): None, ("w", 101): None, ("w", 102): None, ("w", 99): None, ("v", 1): 5}
    assert roster.resolved(spark.createDataFrame([], "work string, id long, to long"), "work").collect() == []


def test_form_flips(spark):
    n, f = "work string, name string", "work string, owner string, form string, pos int"
    old = spark.createDataFrame([("b", "violet"), ("b", "bo"), ("b", "stays"), ("b", "mr x"), ("b", "gone"), ("c", "violet")], n)
    new = spark.createDataFrame([("b", "violet sorrengail"), ("b", "robert"), ("b", "stays"), ("b", "x mr"), ("b", "the boss")], n)
    old_forms = spark.createDataFrame([("b", "gone", "the boss", 3), ("b", "other", "the boss", 9)], f)
    new_forms = spark.createDataFrame([("b", "robert", "bo", 1), ("b", "late", "bo", 2)], f)
    got = sorted(map(tuple, comparison.form_flips(old, new, old_forms, new_forms, "work").collect()))
    assert got == [("b", "bo", "robert", "alias-linked"), ("b", "gone", "the boss", "alias-linked"), ("b", "violet", "violet sorrengail", "token-subset")]


def test_unresolved_ends(spark):
    claims = spark.createDataFrame([("b", 1, "Ann", "Bo"), ("b", 2, " Zed ", "Ann"), ("b", 3, "Zed", "Yan"), ("b", 4, None, "the ann"), ("c", 1, "Ann", "Ann")], "work string, i int, `from` string, `to` string")
    forms = spark.createDataFrame([("b", "ann"), ("b", "bo"), ("c", "ann"), ("c", "")], "work string, form string")
    assert sorted(map(tuple, comparison.unresolved_ends(claims, forms, "work", "i").collect())) == [("b", 4, 3, ["Zed", "Yan", ""]), ("c", 1, 0, [])]


def test_identity_indicators(spark):
    forms = spark.createDataFrame([("b", 1, "peter sebeck"), ("b", 1, "chris ross"), ("b", 2, "peter"), ("b", 3, "chris"), ("b", 4, "natalie philips jr"), ("b", 5, "anna"), ("b", 6, "anna lee")], "work string, entry int, form string")
    entities = spark.createDataFrame([("b", "peter sebeck"), ("b", "chris ross"), ("b", "chris larson"), ("b", "natalie philips"), ("c", "anna")], "work string, entity string")
    got = sorted((r.kind, r.subject, r.others) for r in comparison.identity_indicators(forms, entities, "work").collect())
    # chris fits two people and claims neither; first names alone do fit one
    assert got == [("merge", "1", ["chris ross", "peter sebeck"]), ("split", "peter sebeck", ["1", "2"])]
    claimed = {(r.entry, r.entity) for r in comparison.claimed_entities(forms, entities, "work").collect()}
    assert (4, "natalie philips") in claimed and not any(e == 3 for e, _ in claimed)


def test_empty_evidence_and_prominence(spark):
    claims = spark.createDataFrame([("b", "Parent", None), ("b", "spouse", "q"), ("b", "ally", "  "), ("b", None, "q")], "work string, type string, evidence string")
    assert sorted(map(tuple, comparison.empty_evidence(claims, "work").collect())) == [("b", False, 1, 2), ("b", True, 1, 2)]
    old = spark.createDataFrame([("b", "x", "low"), ("b", "y", "high"), ("b", "z", None), ("b", None, "a")], "work string, k string, v string")
    new = spark.createDataFrame([("b", "x", "high"), ("b", "y", "high"), ("b", "z", "low"), ("b", None, "b"), ("b", "n", "low")], "work string, k string, v string")
    assert sorted(map(str, map(tuple, comparison.prominence_changes(old, new, ["work", "k"], "v").collect()))) == ["('b', 'x', 'low', 'high')", "('b', 'z', None, 'low')", "('b', None, 'a', 'b')"]
