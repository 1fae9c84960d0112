"""Manifest -> long ballot table: one reader per file type, one write per batch.

The delimited files of all counties are scanned in one job, which gives headers,
banners and ballot numbers and lets files with quoted line breaks be read by many
tasks; planning them takes no job per county.  The plan of each county is built on its own, so a county whose files are missing
or malformed is set aside and reported while the others go on.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from tallyline.plans import cleaning as K
from tallyline.sources import delimited as D
from tallyline.sources import layout as Y
from tallyline.sources import nested as M
from tallyline.sources import records as R

KEYS = ("state", "county_name")
Reader = Callable[[SparkSession, str, str, str, DataFrame], DataFrame]


def read_delimited(spark: SparkSession, path: str, state: str, county: str, contests: DataFrame) -> DataFrame:
    """Plain wide file, or one that opens with an election banner."""
    banner = D.has_banner(spark, path)
    raw = D.read_multi_header(spark, path) if banner else D.read_wide_ballots(spark, path)
    return K.clean_wide(raw, state, county, contests)


def read_from_batch(batch: R.Batch, path: str, state: str, county: str, contests: DataFrame) -> DataFrame | None:
    """A county's plain wide files out of a batch; None if another reader has to take them."""
    files = batch.below([path])
    if not files or re.search(D.BANNER, batch.opens_with(files)):
        return None
    return K.clean_wide(batch.read(files, K.NUMBERED, by_scope=False), state, county, contests)


def scanned_together(spark: SparkSession, paths: Sequence[str]) -> R.Batch | None:
    """One scan of all delimited files that exist; None where there are none."""
    conf, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    there = [p for p in paths if (at := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(at)]
    return R.Batch(spark, there, past_faults=True) if there else None


def read_json(spark: SparkSession, path: str, state: str, county: str, contests: DataFrame) -> DataFrame:
    votes = K.vote_partition(M.read_json_ballots(spark, path)).drop("vote_class")
    return K.clean_labelled(votes, state, county, contests)


def read_xml(spark: SparkSession, path: str, state: str, county: str, contests: DataFrame) -> DataFrame:
    return K.clean_labelled(M.read_xml_ballots(spark, path), state, county, contests)


def _plain(cleaner: Callable[[DataFrame, str, str, DataFrame], DataFrame]) -> Reader:
    def read(spark: SparkSession, path: str, state: str, county: str, contests: DataFrame) -> DataFrame:
        raw = D.drop_row_source(D.read_wide_ballots(spark, path))
        return cleaner(raw, state, county, contests)

    return read


def _several(spark: SparkSession, path: str, state: str, county: str, contests: DataFrame) -> DataFrame:
    """Several files of differing columns; ``path`` lists them separated by commas."""
    return K.clean_wide(D.read_many(spark, path.split(",")), state, county, contests)


#: Counties with a layout of their own.
SPECIAL: dict[tuple[str, str | None], Reader] = {
    ("TEXAS", "DENTON"): _plain(K.clean_race_export),
    ("NEW JERSEY", "CUMBERLAND"): _plain(K.clean_vote_flags),
    ("PENNSYLVANIA", "ALLEGHENY"): _plain(K.clean_stacked_export),
    ("FLORIDA", "WALTON"): read_delimited,
    ("FLORIDA", None): _several,
}
READERS: dict[str, Reader] = {"delim": read_delimited, "json": read_json, "xml": read_xml}
#: Readers of files whose contests are values.
LABELLED = {"json": M.read_json_ballots, "xml": M.read_xml_ballots}


def county_ballots(
    spark: SparkSession, kind: str, path: str, state: str, county: str, contests: DataFrame, batch: R.Batch | None = None
) -> DataFrame:
    """Long ballot table of one county, whatever its file type; delimited files come out of ``batch`` where it holds them."""
    reader = READERS.get(kind) or SPECIAL.get((state, county)) or SPECIAL.get((state, None))
    if reader is None:
        raise ValueError(f"no reader for {kind!r} of {county}, {state}")
    long = read_from_batch(batch, path, state, county, contests) if batch is not None and reader is read_delimited else None
    if long is None:
        long = reader(spark, path, state, county, contests)
    # one schema for every county, whatever columns its files had
    types = {c: "bigint" if c == "cvr_id" else "string" for c in K.LONG_COLUMNS}
    full = K.add_missing(long, K.LONG_COLUMNS)
    return full.select(*[full[c].try_cast(t).alias(c) if c == "cvr_id" else full[c].cast(t).alias(c) for c, t in types.items()])


def contests_of_manifest(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Contest names of every county of a manifest that names files by ``delim``, ``json`` or ``xml``.

    Headers of plain delimited files come out of one scan of all of them; a
    stacked header is read per county, and only when the result is; labelled
    files are opened once per county.  Files that are missing have no contests.
    """
    rows = Y.to_build(manifest).collect()
    batch = scanned_together(spark, [r["path"] for r in rows if r["type"] == "delim"])
    known, names, tables = {*K.V.METADATA_COLUMNS, *K.V.PRECINCT_ALIASES}, [], []
    for row in rows:
        place = (row["state"], row["county_name"], row["type"])
        if row["type"] == "delim":
            files = batch.below([row["path"]]) if batch is not None else []
            if files and re.search(D.BANNER, batch.opens_with(files)):
                tables.append((*place, D.read_multi_header(spark, row["path"])))
            else:
                names += [(*place, n) for n in (batch.names(files) if files else []) if n not in known]
        elif row["type"] in LABELLED:
            tables.append((*place, LABELLED[row["type"]](spark, row["path"])))
    found = spark.createDataFrame(names, "state string, county_name string, type string, contest string")
    return found.unionByName(K.discover_contests(tables)) if tables else found


#: What a failed job says when machines, not files, are at fault.
LOST = ("ExecutorLostFailure", "FetchFailed", "OutOfMemoryError", "No space left on device", "SparkContext was shut down")
FAULTS = (PySparkException, Py4JJavaError, ValueError, IndexError)


def _reason(spark: SparkSession, error: Exception) -> str:
    """What is wrong with a county's files; an error of the cluster is raised again."""
    text = str(error)
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped() or any(mark in text for mark in LOST):
        raise error
    return text[:200]


def build_ballots(
    spark: SparkSession, manifest: DataFrame, contests: DataFrame, parties: DataFrame, path: str, together: int = 32
) -> list[tuple[str, str, str]]:
    """Write the counties of a manifest below ``path``; return those set aside.

    ``manifest`` (path, state, county_name, type, build) has a row per county file
    and is read to the driver.  Delimited files are scanned together, so planning their
    counties takes no jobs of their own.  Counties are planned one by one and written
    ``together`` at a time; if such a write fails its counties are written singly,
    so only the faulty ones are missing.  Only written partitions are replaced.
    """
    failed: list[tuple[str, str, str]] = []
    planned: list[tuple[str, str, DataFrame]] = []
    rows = Y.to_build(manifest).collect()
    batch = scanned_together(spark, [r["path"] for r in rows if r["type"] == "delim"])
    for row in rows:
        try:
            long = county_ballots(spark, row["type"], row["path"], row["state"], row["county_name"], contests, batch)
            planned.append((row["state"], row["county_name"], K.merge_party(long, parties).drop("issue")))
        except FAULTS as error:
            failed.append((row["state"], row["county_name"], _reason(spark, error)))
    for start in range(0, len(planned), together):
        failed += _write(planned[start : start + together], path)
    return failed


def _write(counties: Sequence[tuple[str, str, DataFrame]], path: str) -> list[tuple[str, str, str]]:
    try:
        Y.write_partitioned(reduce(DataFrame.unionByName, [c[2] for c in counties]), path, KEYS, "replace")
        return []
    except FAULTS as error:
        reason = _reason(counties[0][2].sparkSession, error)
        if len(counties) == 1:
            return [(counties[0][0], counties[0][1], reason)]
        return [f for county in counties for f in _write([county], path)]
