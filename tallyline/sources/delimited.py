"""Delimited ballot files: typed lookups, wide ballots, stacked headers."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.nulls import holds
from tallyline.functions.text import null_tokens, unique_names
from tallyline.operators.joins import drop_around
from tallyline.session import written_once

#: Column for the text of a record that has not as many cells as the header.
MISFIT = "__misfit"

#: Columns `row_source` adds: where a row lies in the files that were read.
FILE, BLOCK, SPOT = "__file", "__block", "__spot"


def read_typed_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, na: tuple[str, ...] = ("", "NA", "#N/A")
) -> DataFrame:
    """Hand-made lookup file with a declared schema.

    Blanks around values are trimmed (such files carry ``OHIO, MONROE``), and
    the strings that spell a missing value become null in text columns.
    """
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path if isinstance(path, str) else list(path))
    )
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: null_tokens(c, na) for c in texts})


def with_row_source(df: DataFrame) -> DataFrame:
    """Remember file, block and position; call right after the read.

    How files are cut into splits depends on the number of cores unless the
    least number of partitions is set; ``build_session`` sets it, so that a later
    reading of the same files sees the same blocks whatever executors come or go.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(SPOT),
    )


#: Rows numbered in one piece where a block has gaps.
STRETCH = 1 << 16


def number_rows(df: DataFrame, name: str = "idx", scope: Sequence[str] = (FILE,)) -> DataFrame:
    """Dense 1-based row number in file order, per file or per other scope.

    A block of a file is read by one task in order, so a row's place in its
    block is its distance from the block's first row, and a block's place is
    the number of rows before it.  Only one row per block - a file's size over
    the split size - is ever sorted.  That little table is written once, so its
    size is known when the join is planned and ballots stay where they were
    read.  Where rows were removed after the read, a row's place is its rank
    among the rows kept, taken in pieces of :data:`STRETCH` places.  A row that
    does not fit its block is an error, never a wrong number.
    """
    blocks = df.groupBy(*scope, *[c for c in (FILE, BLOCK) if c not in scope]).agg(
        F.count(F.lit(1)).alias("__rows"), F.min(SPOT).alias("__base"), F.max(SPOT).alias("__top")
    )
    order = Window.partitionBy(*scope).orderBy(FILE, BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("__start", F.coalesce(F.sum("__rows").over(order), F.lit(0)))
    keys = list(dict.fromkeys([*scope, FILE, BLOCK]))
    facts = ("__start", "__base", "__rows", "__top")
    known = written_once(starts.select(*keys, *facts), "blocks")
    joined = df.join(known, keys, "left")
    inside = F.col(SPOT).between(F.col("__base"), F.col("__top"))
    if known.where("__top - __base + 1 <> __rows").limit(1).count():
        joined = _ranked_in_block(joined, keys)
    else:
        joined = joined.withColumn("__place", F.col(SPOT) - F.col("__base") + 1)
    changed = F.raise_error(F.lit("the files were split differently while numbering their rows"))
    fits = inside & (F.col("__place") <= F.col("__rows"))
    return joined.withColumn(name, F.when(fits, F.col("__start") + F.col("__place")).otherwise(changed.cast("bigint"))).drop(*facts, "__place")


def _ranked_in_block(joined: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``__place``: 1, 2, ... among the rows a block still has."""
    pieces = joined.withColumn("__piece", F.floor((F.col(SPOT) - F.col("__base")) / STRETCH))
    before = Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieces.groupBy(*keys, "__piece").agg(F.count(F.lit(1)).alias("__size"))
    shifts = written_once(sizes.withColumn("__shift", F.coalesce(F.sum("__size").over(before), F.lit(0))).drop("__size"), "pieces")
    rank = F.row_number().over(Window.partitionBy(*keys, "__piece").orderBy(SPOT))
    placed = pieces.join(shifts, [*keys, "__piece"], "left").withColumn("__place", F.col("__shift") + rank)
    return placed.drop("__piece", "__shift")


def drop_row_source(df: DataFrame) -> DataFrame:
    return df.drop(FILE, BLOCK, SPOT)


def _text_reader(spark: SparkSession, multi_line: bool):
    return (
        spark.read.option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
    )


def _first_records(spark: SparkSession, path: str, n: int, multi_line: bool) -> list[list[str | None]]:
    """The first records of one file; a limit on read, so one split is touched."""
    rows = _text_reader(spark, multi_line).option("header", False).csv(path).limit(n).collect()
    return [list(r) for r in rows]


def _whole_records(spark: SparkSession, path: str, n: int, multi_line: bool) -> list[list[str | None]]:
    """As `_first_records`, each with all its cells; those are cut to the width of the first."""
    reader = _text_reader(spark, multi_line).schema(f"first STRING, {MISFIT} STRING").option("columnNameOfCorruptRecord", MISFIT)
    rows = reader.option("header", False).option("columnPruning", False).csv(path).limit(n).collect()
    return [[c or None for c in next(csv.reader(io.StringIO(r[1], newline="")))] if r[1] else [r[0]] for r in rows]


def header_names(spark: SparkSession, path: str, multi_line: bool = True) -> list[str]:
    """Column names of a ballot file with blanks, repeats and bad bytes repaired."""
    return unique_names(_first_records(spark, path, 1, multi_line)[0])


def listed_files(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """The data files that paths, folders and globs name, in order; nothing of them is read."""
    found = spark.read.format("binaryFile").load([paths] if isinstance(paths, str) else list(paths)).select("path").distinct()
    return sorted(r["path"] for r in found.collect())


def _by_header(spark: SparkSession, paths: Sequence[str], multi_line: bool) -> dict[tuple[str, ...], list[str]]:
    """The files of each header; headers are probed side by side, a few records each."""
    files = listed_files(spark, paths)
    with ThreadPoolExecutor(max_workers=16) as pool:
        headers = list(pool.map(lambda f: _first_records(spark, f, 1, multi_line), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, first in zip(files, headers):
        if first:
            groups.setdefault(tuple(unique_names(first[0])), []).append(path)
    return groups


def _within_width(names: Sequence[str]) -> Column:
    """True; an error where the record kept in :data:`MISFIT` has anything beyond the last of ``names``."""
    bare = F.regexp_replace(MISFIT, r'(^|,)""(?=,|$)', "$1")
    bare = F.regexp_replace(F.regexp_replace(bare, r'(^|,)"(?:[^"]|"")*+"', "$1q"), r"[,\r\n]+$", "")
    wide = F.size(F.split(bare, ",", -1)) > len(names)
    # the message names a cell because Spark reads no file for the text of misfits alone
    told = F.concat(F.lit(f"a record has more than {len(names)} cells; it begins with "), F.coalesce(F.col("`" + names[0].replace("`", "``") + "`"), F.lit("a blank")))
    return F.when(F.col(MISFIT).isNotNull() & wide, F.raise_error(told).cast("boolean")).otherwise(True)


def parse_cells(rows: DataFrame, record: str, names: Sequence[str]) -> DataFrame:
    """``rows`` with the text column ``record`` replaced by its cells, under the rules of a ballot file."""
    made = T.StructType([T.StructField(n, T.StringType()) for n in [*names, MISFIT]])
    rules = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "columnNameOfCorruptRecord": MISFIT, "multiLine": "true", "maxCharsPerColumn": "-1"}
    cells = rows.withColumn("__cells", F.from_csv(record, made.toDDL(), rules))
    kept = [c for c in rows.columns if c != record]
    wide = cells.select(*kept, *[F.col("__cells").getField(n).alias(n) for n in [*names, MISFIT]])
    return wide.where(_within_width(names)).drop(MISFIT)


def _read_whole(
    spark: SparkSession, names: Sequence[str], files: Sequence[str], multi_line: bool, header: bool
) -> DataFrame:
    """Text columns ``names``; a record with anything beyond the last of them is an error, never cut.

    Shorter records end in nulls, and empty cells beyond the last column hold
    nothing.  The check is a filter, so no choice of columns leaves it out.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, MISFIT]])
    reader = _text_reader(spark, multi_line).schema(schema).option("header", header).option("columnNameOfCorruptRecord", MISFIT)
    # a reader that skips columns does not count cells
    reader = reader.option("columnPruning", False)
    return reader.csv(list(files)).where(_within_width(names)).drop(MISFIT)


def read_wide_ballots(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True, row_source: bool = True
) -> DataFrame:
    """Wide ballot file(s): everything text, names as printed in each file's own header.

    Files may order their columns differently or lack some; cells follow the
    printed name, and a column a file lacks is null.  Empty files are skipped.
    A record with more cells than its header is an error when it is read.
    ``multi_line=False`` lets Spark split large files that hold no quoted line
    breaks.
    """
    groups = _by_header(spark, [paths] if isinstance(paths, str) else list(paths), multi_line)
    if not groups:
        raise ValueError(f"no ballot file with a header at {paths}")
    tables = [_read_whole(spark, names, files, multi_line, True) for names, files in groups.items()]
    if row_source:
        tables = [with_row_source(t) for t in tables]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read_many(spark: SparkSession, paths: Sequence[str], multi_line: bool = True) -> DataFrame:
    """Many ballot files as one table; differing columns are filled with nulls."""
    return read_wide_ballots(spark, list(paths), multi_line)


#: Fixed value: what the first cell of an election-banner file holds.
BANNER = r"(?i)2020|General|November"


def has_banner(spark: SparkSession, path: str) -> bool:
    """Does the file open with an election banner (and so stack its headers)?"""
    first = _first_records(spark, path, 1, True)
    return bool(first and first[0] and re.search(BANNER, first[0][0] or ""))


#: Words a title keeps in lower case.
SMALL_WORDS = frozenset("a an and are as at be but by en for if in is nor not of on or per so the to via vs".split())


def title_names(names: Sequence[str]) -> list[str]:
    """Readable unique names: words only, capitalised, small words lower."""
    made: dict[str, int] = {}
    titles = []
    for raw in names:
        words = re.sub(r"[^0-9A-Za-z]+", " ", raw).split()
        title = " ".join(
            w.lower() if k and (w.lower() in SMALL_WORDS or (len(w) == 1 and w.isalpha())) else w[:1].upper() + w[1:].lower()
            for k, w in enumerate(words)
        ) or "X"
        made[title] = made.get(title, 0) + 1
        titles.append(title if made[title] == 1 else f"{title} {made[title]}")
    return titles


def read_multi_header(
    spark: SparkSession, path: str, n_header: int = 3, skip: int = 1, probe: int = 20, multi_line: bool = True
) -> DataFrame:
    """Ballot file with a banner and stacked header rows, possibly repeated mid-file.

    The few header records are read to the driver to build names; the records
    themselves stay distributed.  A record whose ``probe``-th column repeats
    its own header marks a repeated header block, removed with its neighbours.
    """
    head = _whole_records(spark, path, skip + n_header, multi_line)
    width = max(len(r) for r in head)
    stacked = [[*r, *[None] * (width - len(r))] for r in head[skip:]]
    joined = ["_".join(part for part in column if part not in (None, "", "NA")) for column in zip(*stacked)]
    names = title_names([re.sub(r"\.\.\.\d+", "", n) for n in joined])
    raw = _read_whole(spark, [f"c{k}" for k in range(width)], [path], multi_line, False)
    numbered = number_rows(with_row_source(raw), "__idx")
    body = numbered.where(F.col("__idx") > skip + n_header)
    probe_at = min(probe, width) - 1
    label = re.sub(r"\.\.\.\d+$", "", stacked[0][probe_at] or "")
    marks = body.where(holds(F.col(f"c{probe_at}") == label)).select("__idx")
    kept = drop_around(body, "__idx", marks, before=1, after=n_header - 1)
    sources = kept.select(*[F.col(f"c{k}").alias(n) for k, n in enumerate(names)], FILE, BLOCK, SPOT)
    return sources


def drop_last_row(df: DataFrame, index: str, scope: Sequence[str]) -> DataFrame:
    """Drop the totals row some files end with (the greatest index per scope)."""
    last = df.groupBy(*scope).agg(F.max(index).alias(index))
    return df.join(last, [*scope, index], "left_anti")


def fix_cells(df: DataFrame, fixes: Sequence[tuple[str, str]], columns: Sequence[str] | None = None) -> DataFrame:
    """Apply (pattern, replacement) pairs to every listed text cell."""

    def fixed(c: Column) -> Column:
        for pattern, replacement in fixes:
            c = F.regexp_replace(c, pattern, replacement)
        return c

    texts = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name != FILE]
    return df.withColumns({c: fixed(F.col(f"`{c}`")) for c in texts})


#: Fixed value: a 0/1 mark followed by a share, as one county printed it.
MARK_WITH_SHARE = (r"([01]) \([0-9]+%\)", "$1")
