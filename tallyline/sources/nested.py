"""Nested ballot exports: JSON manifests and records, XML ballots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.columns import rename
from tallyline.operators.groups import attach_ids, ordered_ids
from tallyline.operators.joins import star_lookup
from tallyline.plans.parties import standard_party
from tallyline.session import shuffles_freed, written_once

_MARK = "struct<CandidateId:bigint,PartyId:bigint,Rank:int,IsAmbiguous:boolean,IsVote:boolean>"
_CONTEST = f"struct<Id:bigint,Undervotes:int,Overvotes:int,Marks:array<{_MARK}>>"
_SIDE = (
    "struct<PrecinctPortionId:bigint,IsCurrent:boolean,"
    f"Cards:array<struct<Id:bigint,Contests:array<{_CONTEST}>>>>"
)
#: Declared schema: no inference pass over the export files.
EXPORT_SCHEMA = (
    "Version string, Sessions array<struct<TabulatorId:bigint,BatchId:bigint,RecordId:bigint,"
    f"Original:{_SIDE},Modified:{_SIDE}>>"
)


def read_manifest(spark: SparkSession, path: str, fields: dict[str, str]) -> DataFrame:
    """``{Version, List:[...]}`` -> one row per list entry.

    ``fields`` maps our name to ``Name type`` of the entry, e.g.
    ``{"contest": "Description string", "id": "Id bigint"}``.
    """
    entry = ",".join(f"{spec.split()[0]}:{spec.split()[1]}" for spec in fields.values())
    raw = spark.read.schema(f"Version string, List array<struct<{entry}>>").option("multiLine", True).json(path)
    listed = raw.select(F.explode("List").alias("e"))
    return listed.select(*[F.col(f"e.{spec.split()[0]}").alias(name) for name, spec in fields.items()])


def flatten_export(raw: DataFrame) -> DataFrame:
    """Export sessions -> one row per mark (a contest without marks keeps one row).

    Original and modified versions of a record both appear; only the current
    one is kept.
    """
    session = raw.select(F.explode("Sessions").alias("s"))
    versions = F.array_compact(F.array("s.Original", "s.Modified"))
    side = session.select("s.TabulatorId", "s.BatchId", "s.RecordId", F.explode(versions).alias("v"))
    card = side.where("v.IsCurrent").select(
        "TabulatorId", "BatchId", "RecordId", "v.PrecinctPortionId", "v.IsCurrent", F.explode("v.Cards").alias("c")
    )
    contest = card.select("*", F.col("c.Id").alias("CardId"), F.explode("c.Contests").alias("k")).drop("c")
    mark = contest.select("*", F.explode_outer("k.Marks").alias("m"))
    return mark.select(
        F.col("IsCurrent").alias("isCurrent"),
        F.col("BatchId").alias("batchId"),
        F.col("CardId").alias("cardId"),
        F.col("TabulatorId").alias("tabulatorId"),
        F.col("RecordId").alias("recordId"),
        F.col("m.Rank").alias("rank"),
        F.col("m.CandidateId").alias("candidateId"),
        F.col("k.Id").alias("contestId"),
        F.col("m.PartyId").alias("partyId"),
        F.col("PrecinctPortionId").alias("precinctPortionId"),
        F.coalesce("m.IsVote", F.lit(False)).alias("isVote"),
        F.coalesce("m.IsAmbiguous", F.lit(False)).alias("isAmbiguous"),
        F.col("k.Undervotes").alias("undervotes"),
        F.col("k.Overvotes").alias("overvotes"),
    )


#: What the path of an export file, or of the folder of its pieces, holds.
EXPORT_NAME = r"(?i)/[^/]*cvrexport[^/]*\.json(/|$)"


def read_export(spark: SparkSession, folder: str | Sequence[str]) -> DataFrame:
    """Every ``CvrExport*.json`` below the folder, in sub-folders too; other files are not opened."""
    raw = spark.read.schema(EXPORT_SCHEMA).option("multiLine", True).option("recursiveFileLookup", True).json(folder)
    return flatten_export(raw.where(F.col("_metadata.file_path").rlike(EXPORT_NAME)))


def read_json_ballots(spark: SparkSession, folder: str) -> DataFrame:
    """A vendor folder (manifests plus ``CvrExport*.json``) as labelled marks.

    The manifests are small dimension tables of the star; a card's marks share
    one ``cvr_id``, the dense number of (batch, card, tabulator, record).  The export
    is opened once: its marks are written before they are numbered.  The labelled marks
    are written as well, since plans read them more than once, and the shuffle
    files in between go with the writes.
    """
    described = {"id": "Id bigint"}
    district = read_manifest(spark, f"{folder}/DistrictManifest.json", {"district_name": "Description string", **described})
    contest = rename(
        read_manifest(
            spark,
            f"{folder}/ContestManifest.json",
            {"contest": "Description string", "district_of_contest": "DistrictId bigint", **described},
        ).join(rename(district, district_of_contest="id"), "district_of_contest", "left"),
        contest_key="id",
    )
    candidate = rename(
        read_manifest(
            spark,
            f"{folder}/CandidateManifest.json",
            {"candidate": "Description string", "candidate_type": "Type string", **described},
        ),
        candidate_key="id",
    )
    party = read_manifest(spark, f"{folder}/PartyManifest.json", {"party": "Description string", **described})
    party = party.select(standard_party("party").alias("party_detailed"), F.col("id").alias("party_key"))
    portion = read_manifest(
        spark, f"{folder}/PrecinctPortionManifest.json", {"precinct": "Description string", **described}
    ).withColumnRenamed("id", "portion_key")
    with shuffles_freed(spark):
        marks = attach_ids(
            written_once(read_export(spark, folder), "export-marks", "zstd"),
            ["batchId", "cardId", "tabulatorId", "recordId"],
            "cvr_id",
            once=True,
        )
        labelled = star_lookup(
            marks.withColumn("magnitude", F.col("rank").cast("string")),
            [
                (candidate, {"candidateId": "candidate_key"}),
                (contest, {"contestId": "contest_key"}),
                (party, {"partyId": "party_key"}),
                (portion, {"precinctPortionId": "portion_key"}),
            ],
        )
        return written_once(labelled, "json-marks", "zstd")


_OPTION = "struct<Name:string,WriteInData:struct<Text:string>>"
XML_SCHEMA = (
    f"Contests struct<Contest:array<struct<Name:string,Options:struct<Option:array<{_OPTION}>>,Undervotes:string>>>, "
    "PrecinctSplit struct<Name:string>"
)


def read_xml_ballots(spark: SparkSession, path: str, row_tag: str = "CastVoteRecord") -> DataFrame:
    """One XML file per ballot below a folder, sub-folders included -> rows (cvr_id, contest, candidate, precinct).

    A write-in beats the option's name, which beats the undervote marker; every
    option of a contest counts.  The ballot number is the place of its file in
    the order of paths, which moving the whole folder does not change.  The files are
    opened once: their rows are written, and numbers and result are taken from the copy.
    """
    raw = spark.read.format("xml").option("rowTag", row_tag).option("recursiveFileLookup", True).schema(XML_SCHEMA).load(path)
    contests = raw.select(
        F.col("_metadata.file_path").alias("__file"),
        F.col("PrecinctSplit.Name").alias("precinct"),
        F.explode("Contests.Contest").alias("c"),
    )
    options = contests.select("*", F.explode_outer("c.Options.Option").alias("o"))
    marker = F.when(F.col("c.Undervotes").try_cast("int") == 1, F.lit("undervote"))
    writein = F.when(F.col("o.WriteInData.Text").isNotNull(), F.lit("WRITEIN"))
    labelled = options.select(
        "__file",
        F.regexp_replace("c.Name", "\n", " ").alias("contest"),
        F.regexp_replace(F.coalesce(writein, F.col("o.Name"), marker), "\n", " ").alias("candidate"),
        "precinct",
    )
    kept = written_once(labelled, "xml-rows")
    numbered = kept.join(ordered_ids(kept, "__file", "cvr_id"), "__file")
    return numbered.select("cvr_id", "contest", "candidate", "precinct")
