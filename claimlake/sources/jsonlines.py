"""JSON lines as they come from running jobs: torn, blank and foreign lines among them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parsed(lines: DataFrame, schema: str) -> DataFrame:
    """The fields of every line that is a JSON object; blank, torn and non-object lines are skipped. lines: value."""
    good = F.expr("try_parse_json(value)")
    return lines.filter(F.expr("schema_of_variant(try_parse_json(value)) LIKE 'OBJECT%'") & good.isNotNull()).select(F.from_json("value", schema).alias("o")).select("o.*")


def scan(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return parsed(spark.read.text(path), schema)


def tail(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The same as a stream: each file that appears under path is handed out once."""
    return parsed(spark.readStream.text(path), schema)
