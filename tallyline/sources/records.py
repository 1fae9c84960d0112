"""Records of delimited files whose quoted cells hold line breaks, read by many tasks.

A byte range cannot know whether it begins inside a quoted cell.  But every range
maps both start states (outside, inside) to an end state - it flips the state if
it holds an odd number of quotes - and counts the records that begin in it under
either.  One job scans the ranges of all files of a batch into an index of a row
per range; composing the maps of the ranges before gives each its true start
state and the number of its first record.  With those, every range cuts its own
records: lines that are whole records stay where they were read, and only the
pieces of records that span lines meet in a shuffle.

Quotes must follow RFC 4180: a cell with a quote is quoted, and its quotes are
doubled.  Files that use quotes otherwise are read by ``delimited`` with
``multi_line=True``, one task each.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.functions.text import unique_names
from tallyline.session import written_once
from tallyline.shipping import by_value
from tallyline.sources.delimited import BLOCK, FILE, parse_cells

by_value(__name__)

#: Characters of a file's first record that its first range reports.
HEAD = 1 << 20


def _lines(spark: SparkSession, paths: Sequence[str], past_faults: bool = False) -> DataFrame:
    """Lines with file and range, in the order of the file within a task."""
    reader = spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", past_faults)
    return reader.text(list(paths)).select("value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))


def _scan(batches, totals: bool):
    """Per line its parity and what came before it in its range; or a row per range (``totals``)."""
    now, odd, n0, n1, place, head, open_head = None, 0, 0, 0, 0, [], False

    def total():
        whole = "\n".join(head) if head and not open_head else None
        return pa.RecordBatch.from_pydict({FILE: [now[0]], BLOCK: [now[1]], "odd": [odd], "n0": [n0], "n1": [n1], "head": [whole]}, schema=total_schema)

    total_schema = pa.schema([(FILE, pa.string()), (BLOCK, pa.int64()), ("odd", pa.int64()), ("n0", pa.int64()), ("n1", pa.int64()), ("head", pa.string())])
    for batch in batches:
        value, file, block = batch.column(0), batch.column(1), batch.column(2)
        if not len(value):
            continue
        changed = np.ones(len(value), bool)
        changed[1:] = np.asarray(pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1])))
        for start, end in zip(np.flatnonzero(changed), [*np.flatnonzero(changed)[1:], len(value)]):
            key = (file[int(start)].as_py(), block[int(start)].as_py())
            if key != now:
                if totals and now is not None:
                    yield total()
                now, odd, n0, n1, place, head, open_head = key, 0, 0, 0, 0, [], key[1] == 0
            own = value.slice(int(start), int(end - start))
            flips = pc.count_substring(own, '"').to_numpy(zero_copy_only=False).astype(np.int64) & 1
            before = (np.cumsum(flips) - flips + odd) & 1
            filled = ~np.asarray(pc.is_in(own, value_set=pa.array(["", "\r"])))
            begun0, begun1 = n0 + np.cumsum(filled & (before == 0)), n1 + np.cumsum(filled & (before == 1))
            if totals:
                for k in range(len(own)):
                    if not open_head:
                        break
                    if head or filled[k]:
                        head.append(own[k].as_py())
                        # closed by the line after which no quote is open; an overlong head is looked up later
                        open_head = bool(before[k] ^ flips[k]) and sum(map(len, head)) < HEAD
                        if not open_head and before[k] ^ flips[k]:
                            head = []
            else:
                yield pa.RecordBatch.from_arrays([
                    own, file.slice(int(start), int(end - start)), block.slice(int(start), int(end - start)), pa.array(place + np.arange(len(own))),
                    pa.array(flips), pa.array(before), pa.array(filled), pa.array(begun0), pa.array(begun1),
                ], ["value", FILE, BLOCK, "place", "odd", "before_line", "filled", "n0", "n1"])
            odd, n0, n1, place = int((before[-1] + flips[-1]) & 1), int(begun0[-1]), int(begun1[-1]), place + len(own)
    if totals and now is not None:
        yield total()


def block_index(spark: SparkSession, paths: Sequence[str], scope: Column | None = None, past_faults: bool = False) -> DataFrame:
    """A row per range of all files: start state (``inside``), number of records before it in its file (``before``),
    data records before its file in the ``scope`` (an expression over the file's path; its own by default), and the file's ``head``.

    One job whatever the number of files.  ``left_open`` marks files whose last
    quote is never closed.  With ``past_faults`` a file that cannot be read does not
    stop the scan of the others; reading its records still does.
    """
    made = _lines(spark, paths, past_faults).mapInArrow(lambda b: _scan(b, True), f"{FILE} string, {BLOCK} long, odd long, n0 long, n1 long, head string")
    inside_file = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    whole_file = Window.partitionBy(FILE)
    stated = made.withColumn("inside", F.coalesce(F.bit_xor("odd").over(inside_file), F.lit(0))).withColumn("left_open", F.bit_xor("odd").over(whole_file) == 1)
    begun = stated.withColumn("begun", F.when(F.col("inside") == 0, F.col("n0")).otherwise(F.col("n1")))
    counted = begun.withColumn("before", F.coalesce(F.sum("begun").over(inside_file), F.lit(0))).withColumn("in_file", F.sum("begun").over(whole_file))
    counted = counted.withColumn("scope", F.col(FILE) if scope is None else scope)
    # a file's data records count at its first range, so that ranges before it in the scope give its shift
    first = F.row_number().over(Window.partitionBy(FILE).orderBy(BLOCK)) == 1
    counted = counted.withColumn("data", F.when(first, F.greatest(F.col("in_file") - 1, F.lit(0))).otherwise(0))
    earlier = Window.partitionBy("scope").orderBy(FILE).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    shift = F.sum("data").over(earlier) - F.sum("data").over(whole_file)
    return written_once(counted.withColumn("shift", shift).select(FILE, BLOCK, "inside", "before", "in_file", "shift", "left_open", "head"), "ranges")


def split_records(spark: SparkSession, paths: Sequence[str], index: DataFrame) -> DataFrame:
    """``__file``, ``row`` (1 is the header), ``shift`` and ``record`` of every record; blank lines between records are none."""
    made = f"value string, {FILE} string, {BLOCK} long, place long, odd long, before_line long, filled boolean, n0 long, n1 long"
    lines = _lines(spark, paths).mapInArrow(lambda b: _scan(b, False), made)
    met = lines.join(index.select(FILE, BLOCK, "inside", "before", "shift"), [FILE, BLOCK])
    begins = F.col("before_line") == F.col("inside")
    row = F.col("before") + F.when(F.col("inside") == 0, F.col("n0")).otherwise(F.col("n1"))
    placed = met.select(FILE, BLOCK, "place", "value", "shift", "odd", "filled", row.alias("row"), begins.alias("begins")).where("NOT begins OR filled")
    whole = placed.where("begins AND odd = 0").select(FILE, "row", "shift", F.col("value").alias("record"))
    pieces = placed.where("NOT begins OR odd = 1").groupBy(FILE, "row", "shift").agg(F.array_sort(F.collect_list(F.struct(BLOCK, "place", "value"))).alias("parts"))
    joined = pieces.select(FILE, "row", "shift", F.array_join("parts.value", "\n").alias("record"))
    return whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))


def _place(path: str) -> str:
    """A path without scheme and authority, as files are compared."""
    return urlparse(path).path.rstrip("/")


class Batch:
    """The delimited files of many counties, scanned once.

    What the driver holds is a row per file: its name, its number of records and
    its first record.
    """

    def __init__(self, spark: SparkSession, paths: Sequence[str], scope: Column | None = None, past_faults: bool = False) -> None:
        self.spark, self.index = spark, block_index(spark, paths, scope, past_faults)
        facts = self.index.groupBy(FILE).agg(F.max("in_file").alias("held"), F.max("left_open").alias("open"), F.max("head").alias("head"), F.max("shift").alias("shift"))
        self.files = {r[FILE]: r for r in facts.collect()}

    def below(self, paths: Sequence[str]) -> list[str]:
        """The files that are one of ``paths`` or lie in one, in order."""
        own = [_place(p) for p in paths]
        return sorted(f for f in self.files if any((at := _place(unquote(f))) == p or at.startswith(p + "/") for p in own))

    def _first_cells(self, files: Sequence[str]) -> dict[str, list[str | None]]:
        """Cells of the first record of every file that has one; only one longer than its file's first range is looked up."""
        heads = {f: self.files[f]["head"] for f in files if self.files[f]["held"]}
        if missing := [f for f, head in heads.items() if head is None]:
            first = split_records(self.spark, [unquote(f) for f in missing], self.index).where("row = 1")
            heads |= {r[FILE]: r["record"] for r in first.collect()}
        return {f: [c or None for c in next(csv.reader(io.StringIO(head.removesuffix("\r"), newline="")))] for f, head in heads.items()}

    def names(self, files: Sequence[str]) -> list[str]:
        """All column names of ``files``, repaired, in order of appearance."""
        return list(dict.fromkeys(n for _, cells in sorted(self._first_cells(files).items()) for n in unique_names(cells)))

    def opens_with(self, files: Sequence[str]) -> str:
        """The very first cell of ``files``."""
        return next((cells[0] or "" for cells in self._first_cells(files[:1]).values()), "")

    def read(self, files: Sequence[str], number: str = "idx", by_scope: bool = True) -> DataFrame:
        """The data records of ``files``, numbered within the batch's scope, or through ``files`` alone."""
        if broken := [f for f in files if self.files[f]["open"]]:
            raise ValueError(f"a quote stays open to the end of {', '.join(broken[:5])}")
        shift, groups, so_far = {}, {}, 0
        for file, cells in sorted(self._first_cells(files).items()):
            groups.setdefault(tuple(unique_names(cells)), []).append(file)
            shift[file], so_far = so_far, so_far + self.files[file]["held"] - 1
        tables = []
        for names, own in groups.items():
            records = split_records(self.spark, [unquote(f) for f in own], self.index).where("row > 1")
            if by_scope:
                before = F.col("shift")
            else:
                before = F.element_at(F.create_map(*[F.lit(x) for f in own for x in (f, shift[f])]), F.col(FILE))
            tables.append(parse_cells(records.select(FILE, (before + F.col("row") - 1).alias(number), "record"), "record", names))
        if not tables:
            raise ValueError("no ballot file with a header")
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read_split(spark: SparkSession, paths: str | Sequence[str], scope: Column | None = None, number: str = "idx") -> DataFrame:
    """Wide ballot file(s) as ``read_wide_ballots`` gives them, numbered, with files of any size read by many tasks.

    ``number`` counts data records in file order within ``scope``.  Cells follow
    the printed names of each file's header; a record with more cells than its
    header is an error when it is read; empty files are skipped.  The jobs run
    before the result is read do not depend on the number of files.
    """
    batch = Batch(spark, [paths] if isinstance(paths, str) else list(paths), scope)
    return batch.read(sorted(batch.files), number)
