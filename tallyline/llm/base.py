"""What the operators of this subpackage share: tables, scratch copies, names, Python functions by value."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyline.session import scratch_path
from tallyline.shipping import by_value

by_value(__name__)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Java and RE2 spelling of the separators between words; everything else belongs to a word.
GAPS = r"[\x20\x09-\x0D]+"

#: Rows whose ``crc32(doc_id as text) mod 4`` is this are held out from every training.
FOLDS, HELD_OUT = 4, 2


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn(spark, sf_dir)``; ``sql`` is what DuckDB runs on the same tables."""

    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def needed(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only: other columns of the caller, whatever their names, cannot clash."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name, k = stem, 0
    while name.lower() in taken:
        k += 1
        name = f"{stem}_{k}"
    return name


def held_out(doc_id: Column) -> Column:
    """True for the fold no training may see; a null id counts as held out."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(True))


def word_array(text: Column) -> Column:
    """The words of a text, none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAPS, -1), lambda w: w != "")


class Scratch:
    """Copies in the cluster's shared folder that one call owns, removed when it ends.

    Every intermediate table lies in the folder that ``spark.checkpoint.dir``
    names, so a lost executor costs its running tasks only.  :meth:`keep` marks
    the copy a returned DataFrame reads; all others go on exit.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths, self.tables = spark, [], []

    def __enter__(self) -> Scratch:
        return self

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Write a result nothing needs to recompute; its copy outlives this object."""
        out = self.write(df, label)
        self.paths.pop()
        return out

    def write_bucketed(self, df: DataFrame, label: str, buckets: int, key: str) -> DataFrame:
        """A copy whose readers find the rows of one key in one task without another shuffle."""
        name = f"{label}_{uuid.uuid4().hex}"
        self.tables.append(name)
        df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
        return self.spark.table(name)

    def __exit__(self, *exc) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name} PURGE")
        jvm = self.spark._jvm
        for path in self.paths:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


def octets(df: DataFrame, text: str = "text") -> int:
    """Bytes of a text column, counted in one pass."""
    return df.agg(F.sum(F.octet_length(F.col(text)))).head()[0] or 0


def schema(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


def map_texts(df: DataFrame, factory: Callable[[], Callable[[list], dict]], made: str, text: str = "text") -> DataFrame:
    """Replace ``text`` by columns computed from it; all other columns pass through as they are.

    ``factory`` runs once per task and returns the function from a list of texts
    to the new columns, whose names and types ``made`` lists.
    """
    kept = [f for f in df.schema.fields if f.name != text]
    new = schema(made)
    types = to_arrow_schema(new)

    def run(batches):
        fn = factory()
        for batch in batches:
            out = fn(batch.column(batch.schema.get_field_index(text)).to_pylist())
            arrays = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            arrays += [pa.array(out[f.name], f.type) for f in types]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in kept] + [f.name for f in types])

    return df.mapInArrow(run, T.StructType(kept + new.fields))
