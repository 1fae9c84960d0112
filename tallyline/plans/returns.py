"""Official returns -> the standard returns table and county totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.nulls import is_in, replace_where
from tallyline.functions.text import detect, pad_left
from tallyline.operators.groups import filter_modes, sum_by
from tallyline.operators.joins import fill, override
from tallyline.rules import vocabulary as V
from tallyline.sources.layout import append_literals

MODE_KEYS = ("state", "county_name", "precinct", "party_detailed", "writein", "special")
SUM_KEYS = (
    "state", "county_name", "county_fips", "jurisdiction_name", "jurisdiction_fips", "office", "district",
    "magnitude", "special", "writein", "mode", "party_detailed", "party_simplified", "candidate",
)

# fixed values: single corrections (conditions, column values)
PARTY_FIXES = (
    ({"candidate": "ALLEN BUCKLEY", "state": "GEORGIA"}, "INDEPENDENT", "OTHER"),
    ({"candidate": "HOWIE HAWKINS", "state": "WEST VIRGINIA"}, "GREEN", "GREEN"),
    ({"candidate": "GREGORY T HAFEN II", "state": "NEVADA", "county_name": "CLARK"}, "REPUBLICAN", "REPUBLICAN"),
)
# fixed values: candidates whose party the returns leave open
OPEN_PARTY_ROWS = (
    ("STATE HOUSE", "062", "LAURIE RODRIGUEZ-PERSON"),
    ("STATE HOUSE", "088", "RUBIN ANDERSON"),
    ("STATE SENATE", "009", "JESTINE IANNOTTI"),
    ("STATE SENATE", "019", "CHRISTINA PAYLAN"),
    ("STATE SENATE", "023", "ROBERT KAPLAN"),
    ("STATE SENATE", "037", "ALEX RODRIGUEZ"),
    ("STATE SENATE", "039", "CELSO D ALFONSO"),
    ("US HOUSE", "001", "ALBERT ORAM"),
    ("US HOUSE", "017", 'THEODORE "PINK TIE" MURRAY'),
    ("US HOUSE", "018", "K W MILLER"),
    ("US HOUSE", "021", "CHARLESTON MALKEMUS"),
    ("US HOUSE", "024", "CHRISTINE ALEXANDRIA OLIVO"),
)
# fixed values: a result missing from the precinct returns, and one redacted total
MISSING_RESULT = {
    "state": "FLORIDA", "county_name": "BROWARD", "county_fips": "12011", "jurisdiction_name": "BROWARD",
    "jurisdiction_fips": "12011", "office": "STATE HOUSE", "district": "096", "magnitude": 1, "special": 0,
    "writein": 0, "party_detailed": "DEMOCRAT", "party_simplified": "DEMOCRAT",
    "candidate": "CHRISTINE HUNSCHOFSKY", "votes": 66892,
}
REDACTED_TOTAL = ("NYE", "HAFEN", "REPUBLICAN", 19852)


def _where(values: dict[str, str]) -> Column:
    condition = F.lit(True)
    for name, value in values.items():
        condition = condition & (F.col(name) == value)
    return condition


def open_party_table(df: DataFrame) -> DataFrame:
    rows = [("FLORIDA", *r, "NO PARTY AFFILIATION") for r in OPEN_PARTY_ROWS]
    return df.sparkSession.createDataFrame(
        rows, "state string, office string, district string, candidate string, party_detailed string"
    )


def assemble(returns: DataFrame, substitute: DataFrame, substitute_state: str, additions: DataFrame) -> DataFrame:
    """Precinct returns with one state swapped for a newer file, plus manual rows."""
    manual = additions.withColumns({"mode": F.lit("TOTAL"), "jurisdiction_name": F.col("county_name")})
    kept = returns.where(F.col("state") != substitute_state)
    return kept.unionByName(substitute, allowMissingColumns=True).unionByName(manual, allowMissingColumns=True)


def standardise(
    returns: DataFrame,
    offices: Sequence[str] = tuple(V.OFFICES),
    mode_keys: Sequence[str] = MODE_KEYS,
    open_parties: DataFrame | None = None,
) -> DataFrame:
    """Returns rows -> standard labels, one mode system per precinct.

    A single-row correction touches only its row (``party_simplified`` of the
    other rows stays what it was).
    """
    statewide = is_in("state", V.STATEWIDE_STATES)
    rows = returns.where(is_in("office", offices)).withColumns(
        {
            "jurisdiction_name": F.when(~statewide, F.col("jurisdiction_name")),
            "jurisdiction_fips": F.when(~statewide, F.col("jurisdiction_fips")),
            "county_name": replace_where("county_name", statewide, F.lit("STATEWIDE")),
            "writein": F.col("writein").cast("int"),
            "special": F.col("special").cast("int"),
        }
    )
    label = (
        F.when(F.col("candidate") == "UNDERVOTES", "UNDERVOTE")
        .when(F.col("candidate") == "WRITEIN", "WRITEIN")
        .when(F.col("candidate") == "OVERVOTES", "OVERVOTE")
        .otherwise(F.col("party_detailed"))
    )
    federal = replace_where("district", F.col("office") == "US PRESIDENT", F.lit("FEDERAL"))
    dist_state = F.when(is_in("office", V.STATEWIDE_OFFICES), F.col("state"))
    rows = rows.withColumns({"party_detailed": label, "dist_state": dist_state}).withColumn(
        "district", pad_left(F.coalesce("dist_state", federal), 3)
    )
    rows = rows.withColumns(
        {
            "district": replace_where("district", (F.col("state") == "GEORGIA") & (F.col("special") == 1), F.lit("GEORGIA-III")),
            "precinct": replace_where(
                "precinct",
                (F.col("state") == "TEXAS") & is_in("county_name", ("BOSQUE", "COLLIN")),
                pad_left("precinct", 7),
            ),
        }
    )
    for values, detailed, simplified in PARTY_FIXES:
        rows = rows.withColumns(
            {
                "party_detailed": replace_where("party_detailed", _where(values), F.lit(detailed)),
                "party_simplified": replace_where("party_simplified", _where(values), F.lit(simplified)),
            }
        )
    for name in ("party_detailed", "party_simplified"):
        rows = rows.withColumn(name, replace_where(name, F.col(name) == "DEMOCRATIC FARMER LABOR", F.lit("DEMOCRAT")))
    writein_fix = _where({"state": "WISCONSIN", "office": "STATE HOUSE", "candidate": "STEVE KUNDERT"})
    rows = rows.withColumn("writein", replace_where("writein", writein_fix, F.lit(1)))
    single_mode = filter_modes(rows, list(mode_keys), "drop_parts")
    table = open_parties if open_parties is not None else open_party_table(rows)
    return fill(single_mode, table, ["state", "office", "candidate", "district"], "party_detailed")


def county_totals(
    standard: DataFrame, external: DataFrame | None = None, additions: Sequence[dict] = (MISSING_RESULT,)
) -> tuple[DataFrame, DataFrame]:
    """(by county and mode, by county), with known additions to the county table.

    External totals override redacted counts.
    """
    by_mode = sum_by(standard, [k for k in SUM_KEYS if k in standard.columns], "votes")
    by_county = sum_by(by_mode, [k for k in SUM_KEYS if k in standard.columns and k != "mode"], "votes")
    if additions:
        by_county = append_literals(by_county, additions)
    if external is not None:
        keys = ["state", "county_name", "county_fips", "office", "district", "candidate"]
        totals = external.select(*keys, "candidatevotes")
        by_county = override(by_county, totals, keys, "votes", "candidatevotes")
    county, name, party, votes = REDACTED_TOTAL
    redacted = (F.col("county_name") == county) & detect("candidate", name, False) & (F.col("party_detailed") == party)
    return by_mode, by_county.withColumn("votes", replace_where("votes", redacted, F.lit(votes)))

