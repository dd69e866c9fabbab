"""Label files and seat files: hand-worked cases."""

import json

import pytest

from claimlake.sources import labels


def files(spark, **texts):
    return spark.createDataFrame([(k, v if isinstance(v, str) else json.dumps(v)) for k, v in texts.items()], "file string, value string")


def test_pairs_of_both_formats(spark):
    new = [{"name_a": "A", "name_b": "B", "label": "same", "book": "X", "stub_score": 0.9}, {"name_a": "A", "name_b": "C", "label": "different", "scored": False, "desc_a": "d"}]
    old = {"a|b": {"a": "A", "b": "B", "same_person": True}, "u": {"a": "A", "b": "B", "same_person": False, "uncertain": True}, "c": {"a": "C", "b": "D", "same_person": False, "book": "Y"}, "note": "text"}
    got = sorted((r.file, r.at, r.name_a, r.name_b, r.expected, r.book, r.desc_a, r.scored, r.stub_score) for r in labels.pairs(files(spark, new=new, old=old)).collect())
    assert got == [("new", "0", "A", "B", True, "X", "", True, 0.9), ("new", "1", "A", "C", False, "unknown", "d", False, None), ("old", "a|b", "A", "B", True, "unknown", "", True, None), ("old", "c", "C", "D", False, "Y", "", True, None)]


@pytest.mark.parametrize(("bad", "why"), [('"text"', "no list of pairs"), ("{torn", "no list of pairs"), (["x"], "no object"), ([{"name_a": "A", "label": "same"}], "needs name_a"), ([{"name_a": "A", "name_b": "B", "label": "maybe"}], "same or different"), ({"k": {"a": "A"}}, "needs a, b")])
def test_malformed_labels_are_errors(spark, bad, why):
    with pytest.raises(Exception, match=why):
        labels.pairs(files(spark, f=bad)).collect()


def test_labels_are_found_by_id_or_book(spark):
    fixtures = spark.createDataFrame([("b.json", "w1", None), ("a.json", None, "Fourth Wing by Rebecca Yarros"), ("c.json", "w1", "x"), ("d.json", "", "Daemon")], "file string, work_id string, book string")
    works = spark.createDataFrame([("w1", "None", "Nobody"), ("w2", "Fourth Wing", "Rebecca Yárros"), ("w3", "Daemon", None), ("w4", "", "")], "work_id string, title string, author string")
    assert {r.work_id: r.file for r in labels.labels_for(works, fixtures).collect()} == {"w1": "b.json", "w2": "a.json", "w3": None, "w4": None}


def test_seat_lines(spark):
    u = "01234567-89ab-cdef-0123-456789abcdef"
    text = "\n".join([
        "# Verdicts — round: CONFIRM", f"| {u} | Book One | found family | 0.91 | REJECT |", f"- {u.replace('0', '1')} — Book Two — quest — 0.5 — ABSTAIN",
        "- Book Three — slow burn: CONFIRM — it is there, twice", "  Book Four — the heist: REJECT", f"- Book Four — The Heist! (claim {u.replace('0', '2')})", "Odd — no spaces:REJECT", "A long sentence. It says — somewhere: nothing. And then: CONFIRM", "plain", "",
    ])
    rows = labels.seat_lines(files(spark, **{"2026-01-02-seat.md": text}))
    got = {r.line: (r.kind, r.claim, r.book, r.trope, r.verdict, r.rationale) for r in rows.collect()}
    assert got[2] == ("verdict", u, "Book One", "found family", "REJECT", "") and got[3] == ("verdict", u.replace("0", "1"), "Book Two", "quest", "ABSTAIN", "")
    assert got[4] == ("verdict", None, "Book Three", "slow burn", "CONFIRM", "it is there, twice") and got[5][:5] == ("verdict", None, "Book Four", "the heist", "REJECT")
    assert got[6] == ("link", u.replace("0", "2"), "Book Four", "The Heist!", None, None) and got[7][0] == "unresolved" and not {9, 10} & got.keys()
    claims = {r.line: r.claim for r in labels.seat_verdicts(rows).collect()}
    assert claims[5] == u.replace("0", "2") and claims[2] == u and claims[4] is None and {r.date for r in rows.collect()} == {"2026-01-02"}
