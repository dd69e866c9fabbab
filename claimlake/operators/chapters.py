"""Reductions of a book's chapter observations to what is said of the book. All aggregate partially before they shuffle; null keys are a key of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scores

#: How grave an observation is, and the level for a peak band by how often it is reached.
SEVERITIES = ["none", "mentioned", "on_page", "graphic"]
LEVELS = {1: {"rare": 1, "occasional": 1, "frequent": 2, "pervasive": 2}, 2: {"rare": 1, "occasional": 2, "frequent": 3, "pervasive": 4}, 3: {"rare": 2, "occasional": 3, "frequent": 4, "pervasive": 5}}


def coverage(df: DataFrame, keys: list[str], chapter: str, ok: Column) -> DataFrame:
    """chapters_total, chapters_successful, and coverage_warning where under half of the chapters succeeded. A chapter succeeds if any row of it is ok; a null ok is not."""
    each = df.groupBy(*keys, chapter).agg(F.max(F.coalesce(ok, F.lit(False))).alias("__ok"))
    out = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("chapters_total"), F.count_if("__ok").alias("chapters_successful"))
    return out.withColumn("coverage_warning", F.col("chapters_successful") * 2 < F.col("chapters_total"))


def intensity(df: DataFrame, keys: list[str], peak: str) -> DataFrame:
    """level 0 to 5 of each key: its peak's band against the share of rows in that band or above.

    peak counts as 0 to 5, beyond as the nearer end; a null is a failed chapter and counts nowhere.
    """
    x = F.greatest(F.lit(0), F.least(F.lit(5), F.col(peak)))
    seen = df.filter(F.col(peak).isNotNull()).groupBy(*keys).agg(F.max(x).alias("peak"), F.count(F.lit(1)).alias("chapters"), *(F.count_if(x >= floor).alias(f"__{i}") for i, floor in enumerate((1, 2, 4), 1)))
    band = scores.peak_band(F.col("peak"))
    at = F.when(band == 1, F.col("__1")).when(band == 2, F.col("__2")).when(band == 3, F.col("__3")).otherwise(0)
    often = scores.frequency_band(at / F.col("chapters"))
    level = F.lit(0)
    for b, row in LEVELS.items():
        for name, n in row.items():
            level = F.when((band == b) & (often == name), n).otherwise(level)
    return seen.select(*keys, "peak", "chapters", at.cast("long").alias("at_peak"), level.alias("level"))


def prominence(severity: Column, share: Column) -> Column:
    """low, medium or high, by how grave and how frequent; low where either is missing."""
    often = scores.frequency_band(share)
    wide = often.isin("frequent", "pervasive")
    high = ((severity == "graphic") & (often != "rare")) | ((severity == "on_page") & wide)
    medium = (severity == "graphic") | ((severity == "on_page") & (often == "occasional")) | ((severity == "mentioned") & wide)
    return F.when((share > 0) & high, "high").when((share > 0) & medium, "medium").otherwise("low")


def warnings(df: DataFrame, keys: list[str], category: str, chapter: str, severity: str, evidenced: Column, chapters: DataFrame) -> DataFrame:
    """Each category of a key with its gravest severity, the gravest one claimed, its chapters in order, and its prominence.

    An observation beyond mentioned needs evidence, or counts as mentioned; what one chapter alone mentions is dropped.
    chapters: keys and chapters_successful, which the share is taken of (a key that is missing there: share 0). A null or
    unknown severity is none.
    """
    claimed = F.greatest(F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col(severity)).cast("int") - 1, F.lit(0))
    rank = F.when(F.coalesce(evidenced, F.lit(False)), claimed).otherwise(F.least(claimed, F.lit(1)))
    seen = df.withColumn("__claimed", claimed).withColumn("__rank", rank).filter("__claimed > 0")
    out = seen.groupBy(*keys, category).agg(F.max("__rank").alias("__rank"), F.max("__claimed").alias("__claimed"), F.array_sort(F.collect_set(chapter)).alias("chapters"))
    named = [F.element_at(F.array(*map(F.lit, SEVERITIES)), F.col(c) + 1).alias(n) for c, n in (("__rank", "severity"), ("__claimed", "severity_claimed"))]
    kept = out.filter("__rank > 1 OR size(chapters) > 1").select(*keys, category, *named, "chapters", F.size("chapters").cast("long").alias("chapter_count"))
    of = chapters.select(*(F.col(k).alias(f"__{k}") for k in keys), "chapters_successful")
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    share = F.when(F.col("chapters_successful") > 0, F.col("chapter_count") / F.col("chapters_successful")).otherwise(0.0)
    return kept.join(of, same, "left").select(*kept.columns, prominence(F.col("severity"), share).alias("prominence"))


def points_of_view(df: DataFrame, keys: list[str], chapter: str, who: str) -> DataFrame:
    """Who tells two chapters or more, or one in a book of under four chapters; null is nobody."""
    each = df.select(*keys, chapter, who).distinct()
    total = each.groupBy(*keys).agg(F.countDistinct(chapter).alias("__total")).select(*(F.col(k).alias(f"__{k}") for k in keys), "__total")
    told = each.filter(F.col(who).isNotNull()).groupBy(*keys, who).agg(F.count(F.lit(1)).alias("chapter_count"))
    joined = told.join(total, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return joined.filter(F.col("chapter_count") >= F.when(F.col("__total") < 4, 1).otherwise(2)).select(*keys, who, "chapter_count")


def gated(df: DataFrame, keys: list[str], label: str, chapter: str) -> DataFrame:
    """How many labels a key has, one count for each chapter, and how many of them stay under the support floor; percent rounded half even. Null labels take no part."""
    total = df.groupBy(*keys).agg(F.countDistinct(chapter).alias("chapters"))
    counts = df.filter(F.col(label).isNotNull()).groupBy(*keys, label).agg(F.countDistinct(chapter).alias("__n"))
    of = total.select(*(F.col(k).alias(f"__{k}") for k in keys), "chapters")
    each = counts.join(of, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    out = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("labels"), F.count_if(F.col("__n") < scores.support_floor(F.col("chapters"))).alias("below"))
    return out.withColumn("percent", F.bround(100 * F.col("below") / F.col("labels")).cast("long"))


def crossings(df: DataFrame, keys: list[str], level: str) -> DataFrame:
    """The whole levels that a key's values cross: those above its least and up to its largest."""
    ends = df.groupBy(*keys).agg(F.min(level).alias("__lo"), F.max(level).alias("__hi")).filter("floor(__hi) > floor(__lo)")
    return ends.select(*keys, F.explode(F.sequence(F.floor("__lo").cast("long") + 1, F.floor("__hi").cast("long"))).alias("crossed"))
