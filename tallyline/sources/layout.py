"""Partitioned Parquet in and out, reports, manifests, stale partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.nulls import col
from tallyline.functions.text import extract


def read_partitioned(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None, base: str | None = None
) -> DataFrame:
    """Hive-partitioned Parquet; partition keys stay text, filters on them prune.

    With ``schema`` the files are read under a declared schema whatever drift
    they show; with ``base`` a glob below it still yields the partition keys.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if base is not None:
        reader = reader.option("basePath", base)
    paths = [path] if isinstance(path, str) else list(path)
    setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        return reader.parquet(*paths)
    finally:
        spark.conf.set(setting, before)


def write_partitioned(
    df: DataFrame, path: str, keys: Sequence[str], mode: str = "replace", observed: Sequence[Column] = ()
) -> dict:
    """Write one folder per key.

    ``replace`` swaps only the partitions present in ``df`` and leaves the rest;
    ``overwrite`` replaces the whole data set; ``append`` adds files.  Rows are
    rebalanced by key first: AQE merges small counties and splits a county that
    is too large for one task, so neither tiny nor giant files come out.

    Aggregates in ``observed`` are taken from the rows as they are written, in
    the writing stage itself, where a task that is run again counts once; their
    values are returned by name.
    """
    if mode not in ("replace", "overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    dealt, seen = df.hint("rebalance", *[F.col(k) for k in keys]), Observation()
    writer = (dealt.observe(seen, *observed) if observed else dealt).write.partitionBy(*keys)
    if mode == "append":
        writer.mode("append").parquet(path)
    else:
        dynamic = "dynamic" if mode == "replace" else "static"
        writer.mode("overwrite").option("partitionOverwriteMode", dynamic).parquet(path)
    return seen.get if observed else {}


def write_report(df: DataFrame, path: str) -> None:
    """Small report table as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_comparison(by_candidate: DataFrame, by_county: DataFrame, by_candidate_coalesced: DataFrame, path: str) -> None:
    """The three comparison tables, next to each other below ``path``."""
    tables = {
        "by_cand": by_candidate.drop(*[c for c in by_candidate.columns if c.endswith("_c")]),
        "by_county": by_county.drop(
            *[c for c in by_county.columns if c.endswith(("votes_c", "diff_c"))]
        ),
        "by_cand_coalesced": by_candidate_coalesced,
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few literal rows as a table."""
    return spark.createDataFrame(list(rows), schema)


def append_literals(df: DataFrame, rows: Sequence[dict]) -> DataFrame:
    """Union a few literal rows; columns they leave out are null."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    names = list(dict.fromkeys(n for r in rows for n in r))
    schema = T.StructType([T.StructField(n, fields[n]) for n in names])
    extra = df.sparkSession.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
    return df.unionByName(extra, allowMissingColumns=True)


def keys_from_path(path: Column | str) -> tuple[Column, Column]:
    """(state, county) from a file name such as ``CA_Los_Angeles_long.dta``."""
    name = F.element_at(F.split(col(path), "/"), -1)
    return F.substring(name, 1, 2), extract(name, r"(?<=[A-Z][A-Z]_).*(?=(_cvr_info|_long).dta)")


def stale_partitions(existing: DataFrame, manifest: DataFrame, statewide: str = "STATEWIDE") -> DataFrame:
    """Partitions on disk the manifest no longer lists; deleting is the caller's."""
    listed = manifest.select("state", F.coalesce("county_name", F.lit(statewide)).alias("county_name"))
    return existing.select("state", "county_name").distinct().join(listed, ["state", "county_name"], "left_anti")


def to_build(manifest: DataFrame, kind: str | None = None, done: DataFrame | None = None) -> DataFrame:
    """Manifest rows to process: not flagged, of one type, not already exact."""
    rows = manifest.where(F.col("build").isNull()).drop("build")
    rows = rows.withColumn("county_name", F.coalesce("county_name", F.lit("STATEWIDE")))
    if kind is not None:
        rows = rows.where(F.col("type") == kind)
    return rows.join(done, ["state", "county_name"], "left_anti") if done is not None else rows
