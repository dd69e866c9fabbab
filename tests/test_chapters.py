import random

import pytest
from pyspark.sql import functions as F

from claimlake.operators import chapters, clusters, gates


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_levels_follow_peak_and_share(spark):
    books = {"a": ([1] + [0] * 99, 1), "b": ([1] * 20 + [0] * 80, 2), "c": ([3] * 50 + [0] * 50, 4), "d": ([5] + [1] * 40 + [0] * 59, 2), "e": ([5] * 2 + [0] * 28, 3), "f": ([7, -1], 5), "g": ([-3, -1], 0), "h": ([4] * 20 + [0] * 80, 4), "i": ([2, None, None], 4)}
    df = spark.createDataFrame([(k, x) for k, (v, _) in books.items() for x in v], "book string, peak int")
    assert {r.book: r.level for r in chapters.intensity(df, ["book"], "peak").collect()} == {k: want for k, (_, want) in books.items()}
    assert chapters.intensity(df.filter("false"), ["book"], "peak").count() == 0


def test_prominence(spark):
    cases = [("graphic", 2, 73, "medium"), ("mentioned", 20, 73, "medium"), ("on_page", 20, 73, "high"), ("graphic", 10, 73, "high"), ("mentioned", 1, 73, "low"), ("on_page", 1, 73, "low"), ("graphic", 0, 73, "low"), (None, 5, 9, "low")]
    df = spark.createDataFrame(cases, "s string, n int, of int, want string")
    assert df.filter(chapters.prominence(F.col("s"), F.col("n") / F.col("of")) != F.col("want")).count() == 0


def test_warnings_need_evidence_or_a_second_chapter(spark):
    seen = [("b", "sex", 1, "mentioned", None), ("b", "sex", 2, "on_page", True), ("b", "fire", 1, "graphic", True), ("b", "war", 1, "on_page", False), ("b", "theft", 1, "on_page", None), ("b", "theft", 2, "on_page", False), ("b", "lies", 1, "mentioned", None), ("b", "odd", 1, None, True), ("b", "odd", 2, "weird", True), (None, "sex", 1, "graphic", True)]
    df = spark.createDataFrame(seen, "book string, category string, chapter int, severity string, proof boolean")
    cover = chapters.coverage(df, ["book"], "chapter", F.lit(True))
    out = got(chapters.warnings(df, ["book"], "category", "chapter", "severity", F.col("proof"), cover))
    assert out == [("b", "fire", "graphic", "graphic", [1], 1, "high"), ("b", "sex", "on_page", "on_page", [1, 2], 2, "high"), ("b", "theft", "mentioned", "on_page", [1, 2], 2, "medium"), (None, "sex", "graphic", "graphic", [1], 1, "high")]


def test_coverage_counts_chapters_not_rows(spark):
    df = spark.createDataFrame([("b", 1, True), ("b", 1, None), ("b", 2, None), ("b", 3, False), ("c", 1, True)], "book string, chapter int, ok boolean")
    assert got(chapters.coverage(df, ["book"], "chapter", F.col("ok"))) == [("b", 3, 1, True), ("c", 1, 1, False)]


def test_points_of_view(spark):
    df = spark.createDataFrame([("b", 1, "Amy"), ("b", 2, "Amy"), ("b", 2, "Amy"), ("b", 3, "Bob"), ("b", 4, None), ("s", 1, "Solo"), (None, 1, "X")], "book string, chapter int, who string")
    assert got(chapters.points_of_view(df, ["book"], "chapter", "who")) == [("b", "Amy", 2), ("s", "Solo", 1), (None, "X", 1)]


def test_gated_and_crossings(spark):
    df = spark.createDataFrame([("b", "x", c) for c in (1, 2, 3, 3)] + [("b", "y", 1), ("b", None, 2)], "book string, label string, chapter int")
    assert got(chapters.gated(df, ["book"], "label", "chapter")) == [("b", 2, 1, 50)]
    levels = spark.createDataFrame([("b", 1.0), ("b", 3.5), ("c", 2.0), ("d", None), ("e", 1.2), ("e", 1.8)], "book string, level double")
    assert got(chapters.crossings(levels, ["book"], "level")) == [("b", 2), ("b", 3)]


def observed(spark, *runs):
    """runs: (number, independent, {claim: firm}); what became of each claim."""
    rows = [("w", c, n, own, firm) for n, own, seen in runs for c, firm in seen.items()]
    df = spark.createDataFrame(rows, "work string, claim string, run int, own boolean, firm string")
    every = spark.createDataFrame([("w", n) for n, own, _ in runs if own], "work string, run int")
    out = gates.staged(df, ["work", "claim"], "work", "run", F.col("own"), F.col("firm"), runs=every)
    return sorted((r.claim, r.state, r.first_run, r.last_run, r.sightings, r.via) for r in out.collect())


def test_staging_promotes_by_a_second_sighting(spark):
    weak = {"c": None}
    assert observed(spark, (1, True, weak)) == [("c", "staged", 1, 1, 1, None)]
    assert observed(spark, (1, True, weak), (2, True, weak)) == [("c", "promoted", 1, 2, 2, "persistence")]
    assert observed(spark, (1, True, weak), (2, True, {"c": "support"}), (3, True, weak)) == [("c", "promoted", 1, 3, 3, "support")]
    assert observed(spark, (1, True, weak), (2, True, {"c": "evidence"})) == [("c", "promoted", 1, 2, 2, "evidence")]
    assert observed(spark, (1, True, {"c": "evidence"})) == []  # ships without being staged
    assert observed(spark, (1, True, {"c": "support"}), (2, True, weak)) == [("c", "staged", 2, 2, 1, None)]
    assert observed(spark, (1, True, weak), (2, True, weak), *((n, True, {}) for n in range(3, 9))) == [("c", "promoted", 1, 2, 2, "persistence")]


def test_dependent_runs_are_neither_sightings_nor_absences(spark):
    weak, copy = {"c": None}, (2, False, {"c": None})
    assert observed(spark, (1, True, weak), copy) == [("c", "staged", 1, 1, 1, None)]
    assert observed(spark, (1, True, weak), copy, (3, True, weak)) == [("c", "promoted", 1, 3, 2, "persistence")]
    assert observed(spark, copy) == []
    assert observed(spark, (1, True, weak), (2, False, {}), (3, False, {"d": None}), (4, True, {})) == [("c", "staged", 1, 1, 1, None)]


def test_staging_expires_at_three_absences_for_good(spark):
    weak = {"c": None}
    two = [(1, True, weak), (2, True, {}), (3, True, {})]
    assert observed(spark, *two) == [("c", "staged", 1, 1, 1, None)]
    assert observed(spark, *two, (4, True, weak)) == [("c", "promoted", 1, 4, 2, "persistence")]
    assert observed(spark, *two, (4, True, {})) == [("c", "expired", 1, 1, 1, None)]
    assert observed(spark, *two, (4, True, {}), (9, True, weak)) == [("c", "expired", 1, 1, 1, None), ("c", "staged", 9, 9, 1, None)]
    assert observed(spark, *two, (4, True, {}), (9, True, {"c": "evidence"})) == [("c", "expired", 1, 1, 1, None)]


def test_staging_keys_fold_names_into_ids(spark):
    df = spark.createDataFrame([("w", "trope", "Enemies_to Lovers", None, 1), ("w", "trope", "enemies to  lovers", "t-9", 2), ("w", "trope", "Twice", "a", 1), ("w", "trope", "twice", "b", 1), ("w", "trope", "TWICE", "", 1), ("w", "trigger", "  Non_Consent ", None, 1), ("v", "trope", "Enemies to Lovers", None, 1)], "work string, kind string, name string, id string, run int")
    keyed = gates.folded(df, "work", "name", "id").withColumn("key", gates.staging_key(F.col("kind"), F.col("name"), F.col("id")))
    assert sorted(r.key for r in keyed.collect()) == ["trigger:non_consent", "trope:id:a", "trope:id:b", "trope:id:t-9", "trope:id:t-9", "trope:name:enemies to lovers", "trope:name:twice"]
    out = gates.staged(keyed, ["work", "key"], "work", "run", F.lit(True), F.lit(None).cast("string"))
    assert {(r.key, r.state, r.sightings) for r in out.filter("work = 'w' AND key = 'trope:id:t-9'").collect()} == {("trope:id:t-9", "promoted", 2)}
    with pytest.raises(Exception, match="never staged"):
        df.select(gates.staging_key(F.lit("relationship"), F.col("name"), F.col("id"))).collect()


def test_staging_account_shows_what_entries_do_not_explain(spark):
    entries = spark.createDataFrame([("w", "promoted"), ("w", "staged"), ("w", "expired"), (None, "staged"), ("x", "staged")], "work string, state string")
    recorded = spark.createDataFrame([("w", 2), ("w", 2), (None, 1), ("gone", 5)], "work string, n long")
    assert got(gates.staging_account(entries, recorded, ["work"], "n")) == sorted([("w", 4, 1, 1, 1, 1), (None, 1, 1, 0, 0, 0), ("x", 0, 1, 0, 0, -1), ("gone", 5, 0, 0, 0, 5)], key=str)


def test_breakers_need_a_sample(spark):
    df = spark.createDataFrame([("half", i < 4) for i in range(8)] + [("few", True)] * 4 + [("fine", False)] * 9 + [("fine", None)], "book string, bad boolean")
    assert {r.book: r.tripped for r in gates.breakers(df, ["book"], F.col("bad"), 0.5, 5).collect()} == {"half": True, "few": False, "fine": False}


def test_reserves_are_kept_for_later_consumers(spark):
    def granted(budget, rows):
        df = spark.createDataFrame([("p", i, d, r, budget) for i, (d, r) in enumerate(rows)], "pool string, i int, demand long, reserve long, budget long")
        return [r.granted for r in gates.reserved(df, "pool", "i", "demand", "reserve", "budget").orderBy("i").collect()]

    def one_by_one(budget, rows):
        out = []
        for i, (d, _) in enumerate(rows):
            out.append(min(d, max(0, budget - sum(out) - sum(r for _, r in rows[i + 1 :]))))
        return out

    for case in [(50, [(100, 0), (10, 10), (30, 10)]), (50, [(5, 10), (0, 10), (99, 10)]), (5, [(9, 1), (9, 9), (9, 1)]), (0, [(1, 1)])]:
        assert granted(*case) == one_by_one(*case)


def test_dominance(spark):
    df = spark.createDataFrame([("one", 1, 0), ("far", 1, 2000), ("far", 2, 100), ("near", 1, 2000), ("near", 2, 101), ("few", 1, 99), ("few", 2, 0), ("tie", 1, None), ("tie", 2, None)], "title string, id int, readers int")
    assert got(gates.dominant(df, ["title"], "readers", [F.col("id")]).select("title", "id", "dominance")) == [("far", 1, True), ("one", 1, False)]


def test_listing_agreement_and_checks(spark):
    df = spark.createDataFrame([("k", i) for i in range(5)] + [("s", 1), ("s", None)], "k string, v int")
    assert got(gates.listed(df, ["k"], "v", [F.col("v")], most=3)) == [("k", [0, 1, 2], 5, "… and 2 more"), ("s", [1], 1, None)]
    parts = spark.createDataFrame([("w", 1, 1), ("w", 1, 1), ("w", 1, 2), ("w", None, 2)], "k string, a int, b int")
    assert got(gates.agreement(parts, ["k"], "a", "b")) == [("w", 1, 3, 2)]
    assert got(gates.checks(df, {"set": F.col("v").isNotNull(), "small": F.coalesce(F.col("v"), F.lit(0)) < 9})) == [("set", 1, False), ("small", 0, True)]


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(3, 3), (60, 61), (61, 60), (60, 61)]
    df = spark.createDataFrame(links, "a long, b long")
    want = [(i, 100) for i in range(100, 161)] + [(i, 7) for i in range(7, 60)] + [(60, 60), (61, 60)]
    assert got(clusters.components(df)) == sorted(want, key=str)
    assert clusters.components(df.filter("false")).count() == 0


def test_components_send_no_roots_through_the_driver(spark, monkeypatch):
    def forced(df):
        raise AssertionError("a broadcast holds its rows in the driver, whatever the threshold")

    monkeypatch.setattr(clusters.F, "broadcast", forced)
    rnd, root = random.Random(7), list(range(300))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)]
    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    want = [(n, top(n)) for n in {x for a, b in links if a != b for x in (a, b)}]
    df = spark.createDataFrame([*links, (None, 5), (5, None)], "a long, b long")
    assert got(clusters.components(df)) == sorted(want, key=str)


def test_chains_and_canonical_members(spark):
    df = spark.createDataFrame([(1, "Al", 0.5), (2, "Alan", 0.5), (3, "Bo", None), (4, None, None)], "node long, name string, sure double")
    assert got(clusters.chained(df.withColumn("k", F.lit("x")), ["k"], "node", "node")) == [(1, 2), (1, 3), (1, 4)]
    assert clusters.chained(df.withColumn("k", F.lit(None).cast("string")), ["k"], "node", "node").count() == 0
    assert got(clusters.canonical(df.withColumn("root", F.when(F.col("node") < 3, 1).otherwise(3)), "root", "sure", "name", "node")) == [(1, 2, 2, "Alan"), (3, 2, 3, "Bo")]
