"""Figures of evaluations: confusion of classes, decided tiers, a review fixture; each from one pass with partial sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a passage may do for a claim, what stands where no verdict came, and failure classes that a rule could have caught.
PASSAGE_CLASSES = ("supports", "adjacent", "contradicts")
NO_VERDICT = "no-verdict"
STATES = ("shipped", "staged", "dropped", "absent", "no-preview")


def _share(n: Column, of: Column) -> Column:
    return F.when(of > 0, n / of).otherwise(0.0)


def class_confusion(df: DataFrame, keys: list[str], expected: str, got: str, classes: tuple[str, ...] = PASSAGE_CLASSES) -> DataFrame:
    """keys, expected, a count for each class and for NO_VERDICT (null, or any other), n, accuracy: a row for each expected class of a key. leakage: the share of adjacent cases that were taken as support, on the row of adjacent, null elsewhere."""
    said = F.when(F.col(got).isin(*classes), F.col(got)).otherwise(NO_VERDICT)
    each = df.filter(F.col(expected).isin(*classes)).groupBy(*keys, expected).agg(*(F.count_if(said == c).alias(c.replace("-", "_")) for c in (*classes, NO_VERDICT)), F.count(F.lit(1)).alias("n"), F.count_if(said == F.col(expected)).alias("correct"))
    return each.withColumn("accuracy", _share(F.col("correct"), F.col("n"))).withColumn("leakage", F.when(F.col(expected) == "adjacent", _share(F.col("supports"), F.col("n"))))


def decided_tiers(df: DataFrame, keys: list[str], verdict: str, same: Column) -> DataFrame:
    """keys, tp, fp, tn, fn, ambiguous, decided_share, ambiguous_share, accuracy (of the decided): verdicts yes, no and anything else (ambiguous) against whether two are the same; shares of nothing are 0. Rows whose label is null take no part."""
    v, y = F.coalesce(F.col(verdict), F.lit("ambiguous")), same
    x = df.filter(y.isNotNull()).groupBy(*keys).agg(F.count_if((v == "yes") & y).alias("tp"), F.count_if((v == "yes") & ~y).alias("fp"), F.count_if((v == "no") & ~y).alias("tn"), F.count_if((v == "no") & y).alias("fn"), F.count_if(~v.isin("yes", "no")).alias("ambiguous"), F.count(F.lit(1)).alias("__n"))
    done = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    return x.select(*keys, "tp", "fp", "tn", "fn", "ambiguous", _share(done, F.col("__n")).alias("decided_share"), _share(F.col("ambiguous"), F.col("__n")).alias("ambiguous_share"), _share(F.col("tp") + F.col("tn"), done).alias("accuracy"))


def fixture_headline(df: DataFrame, keys: list[str], verdict: str, state: str, structural: Column, interpretation: Column) -> DataFrame:
    """What a review fixture says of the newest previews: structural rejects that shipped all the same, retention (structural confirms that shipped, of those with a preview; null without any) and their number, rejects that came back in any form, interpretation-only entries and their shipped rejects, and entries by state."""
    v, s = F.col(verdict), F.col(state)
    rule, only = F.coalesce(structural, F.lit(False)), F.coalesce(interpretation, F.lit(False))
    confirms = rule & (v == "CONFIRM") & (s != "no-preview")
    x = df.groupBy(*keys).agg(
        F.count_if(rule & (v == "REJECT") & (s == "shipped")).alias("rejects_shipped"), F.count_if(confirms).alias("confirms"), F.count_if(confirms & (s == "shipped")).alias("__kept"), F.count_if((v == "REJECT") & s.isin("shipped", "staged", "dropped")).alias("regenerated"),
        F.count_if(only).alias("interpretation_only"), F.count_if(only & (v == "REJECT") & (s == "shipped")).alias("interpretation_rejects"), *(F.count_if(s == k).alias(k.replace("-", "_")) for k in STATES)
    )
    return x.withColumn("retention", F.when(F.col("confirms") > 0, F.col("__kept") / F.col("confirms"))).drop("__kept")


def labelled_outcomes(df: DataFrame, keys: list[str], label: Column, outcome: str) -> DataFrame:
    """keys, label, and how many labelled pairs came out kept, downgraded, wrong_type, dropped or absent (null: absent)."""
    out = F.coalesce(F.col(outcome), F.lit("absent"))
    return df.filter(label.isNotNull()).groupBy(*keys, label.alias("label")).agg(*(F.count_if(out == c).alias(c) for c in ("kept", "downgraded", "wrong_type", "dropped", "absent")))
