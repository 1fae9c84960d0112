"""The second team's long records -> labelled, then common format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.nulls import holds, is_in, lookup, recode, replace_where
from tallyline.functions.text import pad_left
from tallyline.operators.groups import singletons
from tallyline.operators.joins import checked_join, remap_ids
from tallyline.rules import vocabulary as V

VOTER = ("state", "county", "cvr_id")
META_KEYS = ("state", "county", "column", "item", "choice_id")


def office_type(df: DataFrame) -> DataFrame:
    """Level, partisanship and kind of a contest as one label."""
    level = replace_where("level", F.col("level") == "", F.lit("L"))
    rows = df.withColumn("level", level)
    partisan = holds(F.col("nonpartisan") == 0) | F.col("nonpartisan").isNull()
    nonpartisan = holds(F.col("nonpartisan").isin(1, 2))
    choice, measure = holds(F.col("measure") == 0), holds(F.col("measure") == 1)
    state, local = holds(F.col("level") == "S"), holds(F.col("level") == "L")
    blank = ("NA", "")
    return rows.withColumn(
        "office_type",
        F.when(F.col("level") == "N", "federal")
        .when(state & partisan & choice, "state partisan")
        .when(local & partisan & choice, "local partisan")
        .when(state & nonpartisan & choice, "state nonpartisan")
        .when(local & nonpartisan & choice, "local nonpartisan")
        .when(state & measure, "state measure")
        .when(local & measure, "local measure")
        .when(F.col("retention") == 1, "retention")
        .when(F.col("nonpartisan").isNull() & is_in("choice", blank) & is_in("item", blank), "unclassified"),
    )


def drop_repeated(records: DataFrame, info: DataFrame | None = None) -> DataFrame:
    """Records of one county: merged ids where listed, repeated (voter, column) out."""
    if info is not None:
        records = remap_ids(records, info, "cvr_id", "cvr_id_merged", ["item", "choice"])
    return singletons(records, [c for c in (*VOTER, "column") if c in records.columns])


def voter_labels(
    records: DataFrame, keys: Sequence[str] = VOTER, party: str = "party", president: Column | None = None,
    codes: tuple[str, str, str] = ("DEM", "REP", "LBT"),
) -> DataFrame:
    """Per voter: presidential choice (D, R, LBT) and straight or split ticket.

    A sum over unknown parties is unknown, so such voters get no ticket label.
    """
    first, second, third = codes
    running = president if president is not None else F.col("item") == "US_PRES"
    d, r = (F.col(party) == first).cast("int"), (F.col(party) == second).cast("int")
    facts = records.groupBy(*keys).agg(
        F.bool_or(holds((d == 1) & running)).alias("__pd"),
        F.bool_or(holds((r == 1) & running)).alias("__pr"),
        F.bool_or(holds((F.col(party) == third) & running)).alias("__pl"),
        F.sum(d).alias("__d"),
        F.sum(r).alias("__r"),
        F.bool_or(F.col(party).isNull()).alias("__open"),
    )
    ticket = (
        F.when(F.col("__open"), F.lit(None).cast("string"))
        .when((F.col("__d") > 0) & (F.col("__r") == 0), "DEM")
        .when((F.col("__d") > 0) & (F.col("__r") > 0), "SPL")
        .when((F.col("__d") == 0) & (F.col("__r") > 0), "REP")
    )
    choice = F.when(F.col("__pd"), "D").when(F.col("__pr"), "R").when(F.col("__pl"), "LBT")
    return facts.select(*keys, choice.alias("pres"), ticket.alias("pid"))


def label_records(records: DataFrame, metadata: DataFrame, precincts: DataFrame) -> DataFrame:
    """Records plus choice metadata, precinct and voter labels (all many-to-one)."""
    wanted = [
        *META_KEYS, "office_type", "dist", "party", "incumbent", "measure", "place", "topic", "unexp_term", "num_votes",
    ]
    extra = [c for c in ("choice",) if c in metadata.columns and c not in records.columns]
    meta = metadata.select(*[c for c in (*wanted, *extra) if c in metadata.columns])
    labelled = checked_join(records.drop("line_number"), meta, list(META_KEYS), "inner", "many-to-one")
    voters = voter_labels(labelled.where(F.col("office_type") == "federal"))
    joined = checked_join(labelled, precincts, list(VOTER), "left", "many-to-one")
    return joined.join(voters, list(VOTER), "left")


def to_common(df: DataFrame, spellings: dict[str, str] = V.COUNTY_SPELLINGS) -> DataFrame:
    """Codes -> standard names, districts and columns."""
    special = holds(F.col("item") == "US_SEN (S)")
    named = df.withColumns(
        {
            "county_name": F.upper(F.regexp_replace("county", "_", " ")),
            "office": lookup("item", V.ITEM_OFFICES),
            "candidate": F.upper("choice"),
            "state": lookup("state", V.ITEM_STATES),
            "party_detailed": recode("party", V.ITEM_PARTIES),
        }
    )
    named = named.withColumn(
        "party_detailed", replace_where("party_detailed", is_in("choice", ("UNDERVOTE", "UNDERVOTE?")), F.lit("undervote"))
    )
    named = named.withColumn(
        "party_detailed",
        replace_where("party_detailed", (F.col("choice") != "NA") & (F.col("party_detailed") == "LIB"), F.lit("LIBERTARIAN")),
    )
    at_large = (F.col("office") == "US HOUSE") & is_in("state", V.AT_LARGE_STATES)
    district = F.when(at_large, "000").when(F.col("office") == "US PRESIDENT", "FEDERAL").otherwise(pad_left("dist", 3))
    statewide = F.when(is_in("office", V.STATEWIDE_OFFICES), F.col("state"))
    seat = F.when(special & (F.col("state") == "GEORGIA"), "GEORGIA-III").otherwise(F.coalesce(statewide, district))
    rows = named.withColumn("district", seat).withColumn("county_name", recode("county_name", spellings))
    columns = ["state", "county_name"]
    for part in ("cvr_id", "precinct", "pres", "voter_id", "choice2"):
        columns += [c for c in rows.columns if part in c and c not in columns]
    columns += ["office", "district", "candidate", *[c for c in rows.columns if c == "column"]]
    return rows.select(*columns, F.col("num_votes").alias("magnitude"), "party", "party_detailed")


def keep_items(df: DataFrame) -> DataFrame:
    return df.where(is_in("item", tuple(V.ITEM_OFFICES)))
