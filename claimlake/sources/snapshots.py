"""Snapshots that are whole or not there: chunks first, then a manifest of their contents, last the mark that ends it."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the version of the layout.
LAYOUT = 1


def manifest_of(rows: DataFrame) -> DataFrame:
    """chunk, n, content: rows of each chunk and a sum of their 64-bit hashes, which tells contents, not order."""
    columns = [c for c in rows.columns if c != "chunk"]
    own = F.xxhash64(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})).cast("decimal(38,0)")
    return rows.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.sum(own).cast("string").alias("content"))


def write(df: DataFrame, path: str, key: str, chunks: int = 200, **about: str) -> str:
    """Writes df in chunks dealt by key and ends the snapshot; its digest. about: what else the mark says.

    A run that is killed before the end leaves no snapshot that read() takes; written anew, it needs another path.
    """
    spark = df.sparkSession
    dealt = df.withColumn("chunk", F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int"))
    dealt.repartition("chunk").write.partitionBy("chunk").mode("errorifexists").parquet(f"{path}/rows")
    manifest = manifest_of(spark.read.schema(dealt.schema).parquet(f"{path}/rows"))
    manifest.coalesce(1).write.json(f"{path}/manifest")
    digest = _digest(_manifest(spark, path))
    mark = json.dumps({"layout": LAYOUT, "digest": digest, "schema": df.schema.json(), **about}, sort_keys=True)
    spark.createDataFrame([(mark,)], "value string").coalesce(1).write.text(f"{path}/final")
    return digest


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("chunk int, n long, content string").json(f"{path}/manifest")


def _digest(manifest: DataFrame) -> str:
    line = F.concat_ws(":", "chunk", "n", "content")
    return manifest.agg(F.sha2(F.array_join(F.sort_array(F.collect_list(line)), ","), 256)).first()[0]  # a line for each chunk


def mark(spark: SparkSession, path: str) -> dict | None:
    """What the mark of a snapshot says; None for a snapshot that has not been ended."""
    from pyspark.errors import AnalysisException

    try:
        lines = spark.read.text(f"{path}/final", wholetext=True).collect()
    except AnalysisException:
        return None
    return json.loads(lines[0][0]) if len(lines) == 1 else None


def read(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """The rows of an ended snapshot. check: contents are held against the manifest, and the manifest against the mark; any difference is an error, and nothing is read by halves."""
    from pyspark.sql.types import IntegerType, StructField, StructType

    said = mark(spark, path)
    if said is None:
        raise ValueError(f"no whole snapshot at {path}")
    if said["layout"] != LAYOUT:
        raise ValueError(f"snapshot at {path} has layout {said['layout']}, not {LAYOUT}")
    schema = StructType.fromJson(json.loads(said["schema"]))
    rows = spark.read.schema(StructType([*schema, StructField("chunk", IntegerType())])).parquet(f"{path}/rows")
    if check:
        manifest = _manifest(spark, path)
        if _digest(manifest) != said["digest"]:
            raise ValueError(f"manifest of {path} is not the one that its mark tells of")
        have = manifest_of(rows).select(F.col("chunk").alias("c"), F.col("n").alias("m"), F.col("content").alias("x"))
        bad = manifest.join(have, F.col("chunk") == F.col("c"), "full").filter(~(F.col("n").eqNullSafe(F.col("m")) & F.col("content").eqNullSafe(F.col("x")))).select(F.coalesce("chunk", "c")).limit(5).collect()
        if bad:
            raise ValueError(f"chunks {sorted(r[0] for r in bad)} of {path} do not hold what the manifest says")
    return rows.drop("chunk")


def restore(spark: SparkSession, path: str, live: DataFrame, key: str, keep: str, chunks: int = 200) -> DataFrame:
    """The rows of a snapshot, after what stood in its place (live) was itself written as a snapshot at keep, so that the restoring can be undone. Nothing is written if the snapshot cannot be read whole."""
    rows = read(spark, path)
    write(live, keep, key, chunks, replaced_by=path)
    return rows
