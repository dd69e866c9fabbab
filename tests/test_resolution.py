import tracemalloc

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimlake.functions.passages import packed, passages, spans
from claimlake.operators import resolution


def test_aliases_own_entry_first(spark):
    forms = spark.createDataFrame([("ann", 1, 1, "k9"), ("ann", 0, 5, "k1"), ("ann", 0, 7, "k2"), ("bo", 1, 2, "k3"), (None, 0, 0, "k7")], "form string, rank int, at int, key string")
    links = spark.createDataFrame([("ann", "bo", 1), ("ann", "ann", 2), ("ann", "cy", 3), (None, "bo", 4)], "a string, b string, key int")
    got = {r["key"]: (r["from_key"], r["to_key"], r["skipped"]) for r in resolution.through_aliases(links, forms, "a", "b").collect()}
    assert got == {1: ("k1", "k3", False), 2: ("k1", "k1", True), 3: ("k1", None, True), 4: (None, "k3", True)}


def test_longest_prefix_abstains(spark):
    entries = spark.createDataFrame([("ann", "e1"), ("ann lee", "e2"), ("ann lee", "e2"), ("bo", "e3"), ("bo", "e4"), (None, "e5")], "form string, entity string")
    forms = spark.createDataFrame([("ann lee smith",), ("ann smith",), ("bo x",), ("anna",), (None,), ("",), ("ann smith",)], "form string")
    got = {r["form"]: (r["entity"], r["matched"]) for r in resolution.by_longest_prefix(forms, entries, "form").collect()}
    assert got == {"ann lee smith": ("e2", "ann lee"), "ann smith": ("e1", "ann"), "bo x": (None, None), "anna": (None, None), None: (None, None), "": (None, None)}


def test_id_prefix_unique_or_none(spark):
    works = spark.createDataFrame([("abcd1",), ("abcd2",), ("abce1",), ("abce1",), (None,)], "work string")
    queries = spark.createDataFrame([("abcd",), ("abcd2",), ("abce",), ("abc",), ("zzzz",), (None,)], "q string")
    assert {r["q"]: r["work"] for r in resolution.by_id_prefix(queries, works, "q", "work").collect()} == {"abcd": None, "abcd2": "abcd2", "abce": "abce1", "abc": None, "zzzz": None}


def test_tiers_unique_or_abstain(spark):
    schema = "id int, a string, b string"
    old = spark.createDataFrame([(1, "x", "p"), (2, "y", "q"), (3, "y", "r"), (4, None, "s"), (5, None, "s")], schema)
    new = spark.createDataFrame([(11, "x", "q"), (12, "y", "q"), (13, None, "r"), (14, None, "s")], schema)
    got = {tuple(r) for r in resolution.by_tiers(old, new, "id", ["a", "b"]).collect()}
    assert got == {(1, 11, 0), (2, 12, 1), (3, 13, 1)}


def test_settled_null_keys_and_values(spark):
    old = spark.createDataFrame([(1, None, "h"), (2, 1, "h"), (3, 1, None), (4, 1, "h")], "w int, k int, v string")
    new = spark.createDataFrame([(1, None, "h"), (2, 1, "g"), (3, 1, None), (5, 1, "h")], "w int, k int, v string")
    assert {r["w"]: r["action"] for r in resolution.settled(old, new, ["w", "k"], "v").collect()} == {1: "reused", 2: "written", 3: "reused", 4: "deleted", 5: "written"}


def test_placed_split_names_deciles(spark):
    fixture = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    got = resolution.placed(fixture, {"shipped": fixture.filter("k = 1"), "staged": fixture.filter("k <= 2 OR k IS NULL")}, ["k"])
    assert {r["k"]: r["state"] for r in got.collect()} == {1: "shipped", 2: "staged", 3: "absent", None: "absent"}
    titles = spark.createDataFrame([("Emma",), ("ULYSSES",), (None,)], "title string")
    splits = spark.createDataFrame([("EMMA", "test"), ("emma", "held_out"), (None, "test")], "title string, split string")
    assert {r["title"]: r["split"] for r in resolution.split_of(titles, splits, "title").collect()} == {"Emma": "held_out", "ULYSSES": "train", None: "train"}
    seen = spark.createDataFrame([(1, "a", 2), (1, "a", 1), (1, "b", 2), (1, None, 1), (None, "a", 3)], "w int, name string, ch int")
    assert {tuple(r) for r in resolution.new_names(seen, ["w"], "name", "ch").collect()} == {(1, 1, 1), (1, 2, 1), (None, 3, 1)}
    scores = spark.createDataFrame([("a", i / 10) for i in range(11)] + [("a", None), ("a", float("nan")), ("b", None)], "k string, s double")
    (row,) = resolution.deciles(scores, ["k"], "s").collect()
    assert (row["k"], row["n"], [round(d, 6) for d in row["deciles"]]) == ("a", 11, [i / 10 for i in range(1, 10)])


def windows_by_definition(text, most):
    cuts, begun = [], 0
    for i in range(1, len(text) + 1):
        ended = i == len(text) or (text[i] not in " \n" and text[i - 1] in " \n" and text[:i].rstrip(" \n")[-1:] in (".", "!", "?"))
        if ended or i - begun == most:
            cuts.append((begun, i))
            begun = i
    stops = [(a, max(e for _, e in cuts if e == b or a < e <= a + most)) for a, b in cuts]
    return [w for i, w in enumerate(stops) if i == 0 or w[1] > stops[i - 1][1]]


@settings(max_examples=300, deadline=None)
@given(st.text("ab.! \n", max_size=60), st.integers(3, 20))
def test_spans_by_definition(text, most):
    text = text.lstrip(" \n")
    assert [(s["start"], s["stop"]) for s in spans(text, most)] == windows_by_definition(text, most)


def test_passages_of_odd_texts(spark):
    texts = spark.createDataFrame([(1, None), (2, ""), (3, "One. Two é𝒳."), (4, "x" * 1_000_000), (5, "A. " * 100_000)], "id int, text string")
    got = {r["id"]: r for r in texts.select("id", F.size(passages("text")).alias("n"), F.element_at(passages("text"), -1)["stop"].alias("stop"), F.length("text").alias("len")).filter("id > 2").collect()}
    assert got[3]["n"] == 1 and got[4]["n"] == 1667 and all(r["stop"] == r["len"] for r in got.values())


def test_passages_hold_two_integers_a_window():
    """A worker held an object and two boxed numbers for each window of a batch: 24 MB here."""
    texts = pa.array(["A. " * 100_000, None, ""])
    tracemalloc.start()
    got = packed(texts, 600)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got[0]) == 99_801 and got[0].as_py()[-1] == {"start": 299_400, "stop": 300_000} and peak < 6_000_000
    assert got[1].as_py() == got[2].as_py() == [] == packed(pa.array([None], pa.string()), 600)[0].as_py() and len(packed(texts[:0], 600)) == 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], "form string, entity string, rank int, at int, key string, a string, b string")
    assert resolution.by_longest_prefix(none, none, "form").count() == resolution.by_tiers(none, none, "key", ["a", "b"]).count() == 0
    assert resolution.through_aliases(none.select("a", "b"), none, "a", "b").count() == resolution.settled(none, none, ["a", "b"], "form").count() == 0
