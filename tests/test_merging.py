"""Tiers of names and nominated pairs: hand-worked cases."""

from pyspark.sql import functions as F

from claimlake.operators import merging


def test_tiers(spark):
    rows = [
        ("special agent neal decker", "neal decker", False, "yes"),
        ("agent roy merritt", "roy merritt", True, "yes"),
        ("the late matthew sobol", "matthew sobol", False, "yes"),
        ("matthew a. sobol", "matthew sobol", False, "yes"),
        ("joseph pavlos", "josef pavlos", False, "ambiguous"),
        ("pete sebeck", "peter sebeck", False, "yes"),
        ("sebeck", "peter sebeck", False, "ambiguous"),
        ("mosely", "charles mosely", False, "ambiguous"),
        ("mosely", "charles mosely", True, "no"),
        ("chris sebeck", "peter sebeck", False, "no"),
        ("laura sebeck", "peter sebeck", False, "no"),
        ("special agent neal decker", "neal decker", True, "yes"),
        ("chris sebeck", "peter sebeck", True, "no"),
        ("jon ross", "jason heider", False, "ambiguous"),
        ("j ross", "jon ross", False, "ambiguous"),
        ("jon ross", "jason heider", True, "no"),
        ("", "jon ross", True, "ambiguous"),
        (None, None, None, "ambiguous"),
        ("the", "the", False, "yes"),
    ]
    df = spark.createDataFrame(rows, "a string, b string, together boolean, want string")
    nick = F.create_map(F.lit("pete"), F.lit("peter"), F.lit("bob"), F.lit("robert"))
    for x, y in (("a", "b"), ("b", "a")):
        out = df.withColumn("got", merging.merge_tier(F.col(x), F.col(y), F.col("together"), nick))
        assert out.filter("got <> want").collect() == []
    words = spark.createDataFrame([("joseph", "josef", True), ("mosely", "mosley", True), ("sebeck", "sebeckx", True), ("chris", "peter", False), ("sebeck", "sebickson", False), ("same", "same", False)], "a string, b string, want boolean")
    assert words.filter(merging.spelling_variant(F.col("a"), F.col("b")) != F.col("want")).collect() == []


def test_nominations(spark):
    people = [("f", n) for n in ("general sorrengail", "lilith sorrengail", "mira sorrengail", "violet sorrengail", "sorrengail", "xaden riorson", "dr. reyes", "tomas reyes", "xaden", "", None)] + [("g", "mira sorrengail"), ("g", "xaden riorson")]
    got = {(r.work, r.a, r.b): tuple(r.signals) for r in merging.nominated(spark.createDataFrame(people, "work string, name string"), "work", "name").collect()}
    assert got["f", "general sorrengail", "lilith sorrengail"] == ("shared_surname", "title_form")
    assert got["f", "mira sorrengail", "violet sorrengail"] == ("shared_surname",)
    assert got["f", "lilith sorrengail", "sorrengail"] == ("containment",)
    assert got["f", "dr. reyes", "tomas reyes"] == ("shared_surname", "title_form") and got["f", "xaden", "xaden riorson"] == ("containment",)
    assert len(got) == 6 + 4 + 2 and not any(w == "g" for w, _, _ in got)
    pairs = merging.nominated(spark.createDataFrame(people, "work string, name string"), "work", "name")
    asked = {(r.a, r.b) for r in merging.for_the_judge(pairs, merging.merge_tier(F.col("a"), F.col("b"))).collect()}
    assert ("general sorrengail", "lilith sorrengail") in asked and ("mira sorrengail", "violet sorrengail") not in asked and ("lilith sorrengail", "mira sorrengail") not in asked
