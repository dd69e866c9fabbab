import random

import pytest
from pyspark.sql import functions as F

from claimlake.operators import joins, ledger, reduce
from claimlake.sources import jsonlines
from claimlake.streaming import windows


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def hot_rows(n=6000):
    """Three keys, one of them null, one with most rows; states that often repeat."""
    rnd = random.Random(4)
    return [(rnd.choice(["hot"] * 8 + ["cold", None]), i, rnd.choice(["a", "a", "a", "b", None]), rnd.randint(0, 3)) for i in range(n)]


def by_key(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("together", [100, 1_000_000])
def test_pieces_of_a_hot_key_add_up(spark, monkeypatch, together):
    monkeypatch.setattr(reduce, "TOGETHER", together)
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, i long, s string, n long").repartition(5)
    assert reduce.pieced(df, ["k"], ["i"]).filter("k = 'hot'").select("__piece").distinct().count() > (50 if together == 100 else 0)
    flips, islands, sums = {}, [], []
    for k, own in by_key(rows).items():
        states = [r[2] for r in own]
        flips[k] = sum(a != b for a, b in zip(states, states[1:]) if a and b)
        running = 0
        for j, r in enumerate(own):
            running += r[3]
            sums.append((r[1], running, running <= 2000))
            if j == 0 or not (r[2] and states[j - 1] == r[2]):
                islands.append([k, r[2], r[1], r[1], 0])
            islands[-1][3:] = [r[1], islands[-1][4] + 1]
    assert {r.k: r.n_flips for r in reduce.flips(df, ["k"], "i", "s").collect()} == flips
    assert got(reduce.runs(df, ["k"], "i", "s").drop("island")) == sorted(map(tuple, islands), key=str)
    assert got(reduce.admitted(df, "k", ["i"], "n", 2000).select("i", "running", "granted")) == sorted(sums, key=str)
    for f in (lambda x: reduce.flips(x, ["k"], "i", "s"), lambda x: reduce.runs(x, ["k"], "i", "s"), lambda x: reduce.admitted(x, "k", ["i"], "n", 1)):
        assert f(df.filter("false")).count() == 0


@pytest.mark.parametrize("together", [100, 1_000_000])
def test_as_of_join_carries_over_pieces(spark, monkeypatch, together):
    monkeypatch.setattr(reduce, "TOGETHER", together)
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, i long, s string, n long")
    left, right = df.filter("n > 0"), df.filter("n = 0").withColumnRenamed("s", "v")
    want, last = [], {}
    for k, i, s, n in rows:
        if n == 0:
            last[k] = s or last.get(k)
        else:
            want.append((i, last.get(k)))
    assert got(joins.nearest_before(left, right, "k", "i", "v").select("i", "before_v")) == sorted(want, key=str)


def test_rekeying_replaces_what_stood_there(spark):
    df = spark.createDataFrame([("s", "old", 1), ("s", "new", 2), ("s", "else", 3), ("t", "old", 4), (None, "old", 5), ("s", None, 6)], "g string, k string, v int")
    moves = spark.createDataFrame([("s", "old", "new"), ("t", "old", "old"), (None, "old", "new")], "g string, old string, new string")
    assert got(ledger.rekeyed(df, "g", "k", moves)) == sorted([("s", "new", 1), ("s", "else", 3), ("t", "old", 4), (None, "old", 5), ("s", None, 6)], key=str)


def test_plan_says_what_the_replacement_does(spark):
    old = spark.createDataFrame([("w", "a", "ai", "pending"), ("w", "b", "ai", "confirmed"), ("w", "c", None, None), ("w", "e", "ai", None), ("w", "f", "ai", ""), ("x", "a", "ai", "pending")], "w string, k string, made string, status string")
    new = spark.createDataFrame([("w", k, "ai", None) for k in "abdef"], old.schema)
    made, status = F.col("made") == "ai", F.col("status")
    assert got(ledger.write_plan(old, new, ["w", "k"], ["w"], made, status)) == [("w", 1, 4, 2, 3)]
    after = joins.replace_uncurated(old, new, ["w", "k"], ["w"], made, status)
    assert after.filter("w = 'w'").count() == 4 + 2


def test_family_claims_come_first(spark):
    df = spark.createDataFrame([("w", "A", "B", "ally", 9, 1), ("w", "B", "A", "parent", None, 2), ("w", "A", "B", "parent", 1, 3), ("w", "A", "C", None, 1, 4)], "w string, a string, b string, kind string, n int, i int")
    assert got(ledger.one_a_pair(df, ["w"], "a", "b", F.col("kind") == "parent", "n", [F.col("i")]).select("i", "stood", "family_claims")) == [(3, 3, 2), (4, 1, 0)]


def test_states(spark):
    df = spark.createDataFrame([(1, None, None, None, "p2"), (2, 3, 0, 0, "p1"), (3, 3, 5, None, "p2"), (4, 3, 5, 2, None), (5, 3, 5, 5, "p2")], "w int, c int, p int, v int, parser string")
    assert [tuple(r) for r in ledger.completeness(df, "w", "c", "p", "v", "parser", "p2").orderBy("w").collect()] == [(1, "absent", False), (2, "ingesting", True), (3, "text_complete", False), (4, "vectors_partial", True), (5, "complete", False)]


def test_fields_present_empty_and_missing(spark):
    schema = "w int, f string, x string"
    old = spark.createDataFrame([(1, "t", "a"), (1, "t", "b"), (1, "empty", None), (1, "only", "a")], schema)
    new = spark.createDataFrame([(1, "t", "b"), (1, "t", "c"), (1, "empty", None)], schema)
    out = ledger.field_agreement(old, new, ["w"], "f", "x")
    assert got(out) == [(1, "empty", 0, 0, 0, 1.0), (1, "only", 0, 0, 1, None), (1, "t", 1, 1, 1, 1 / 3)]
    assert got(ledger.overall(out, ["w"])) == [(1, (1 + 1 / 3) / 2, 2)]


def test_batches_mix_four_to_one(spark):
    rows = [("w", i, 0.80 + i / 1000, False) for i in range(30)] + [("w", 100 + i, 0.5, True) for i in range(30)] + [("w", 200, 0.65, True), ("w", 201, None, True), ("w", 202, 0.75, False), ("w", 203, 0.74, False)]
    df = spark.createDataFrame(rows, "w string, i int, p double, family boolean")
    out = ledger.labelling_batch(df, "w", "i", "p", F.col("family"), "s")
    assert {r.reason: r["count"] for r in out.groupBy("reason").count().collect()} == {"near_bar": 16, "control": 4}
    few = ledger.labelling_batch(df.filter("i >= 200"), "w", "i", "p", F.col("family"), "s")
    assert {r.i: r.reason for r in few.collect()} == {200: "near_band_edge", 202: "near_bar", 203: "control"}


def test_budget_outcomes_and_bars(spark):
    df = spark.createDataFrame([("b", 1, 3), ("b", 2, None), ("b", 3, 4), ("b", 4, 1)], "b string, i int, n int")
    assert got(ledger.within_tokens(df, ["b"], [F.col("i")], "n", 6).select("i", "used")) == [(1, 3), (2, 3)]
    claims = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "i int, k string")
    outcomes = spark.createDataFrame([("a", "kept", 1), ("a", "dropped", 2), (None, "kept", 1)], "k string, o string, at int")
    assert got(ledger.matched_outcomes(claims, outcomes, ["k"], [F.col("at")]).select("i", "joined", "o")) == [(1, True, "dropped"), (2, True, "kept"), (3, False, None)]
    scores = spark.createDataFrame([("m", 0.9, True), ("m", 0.2, True), ("m", None, True)], "g string, p double, y boolean")
    assert got(ledger.calibration(scores, ["g"], "p", F.col("y"), [0.5])) == [("m", True, 0.5, 2, 1, 1, 0.55)]


def test_sessions_over_a_stream(spark, tmp_path):
    line = '{"run": "%s", "ts": "2024-01-01T%s"}'
    path = str(tmp_path / "in")
    spark.createDataFrame([(line % x,) for x in [("a", "00:00:00"), ("a", "00:20:00"), ("a", "02:00:00"), ("b", "00:10:00"), ("b", "09:00:00")]], "value string").coalesce(1).write.text(path)
    schema = "run string, ts timestamp"
    want = got(windows.sessions(jsonlines.scan(spark, path, schema), "ts", ["run"], "30 minutes").select("run", "n"))
    assert want == [("a", 1), ("a", 2), ("b", 1), ("b", 1)]
    run = windows.sessions(jsonlines.tail(spark, path, schema), "ts", ["run"], "30 minutes").writeStream.format("memory").queryName("spells").outputMode("append").option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
    run.awaitTermination(100)
    assert got(spark.table("spells").select("run", "n")) == [("a", 1), ("a", 2), ("b", 1)]  # the last is still open
