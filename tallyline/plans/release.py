"""From two teams' ballots to the released, redacted subset, and its checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.nulls import holds, if_else, is_in, not_in, recode, replace_where
from tallyline.functions.text import comma_number
from tallyline.operators.columns import drop_matching, reorder
from tallyline.operators.groups import count_of_counts, keep_group_size, tally
from tallyline.operators.joins import checked_join, fill, prefer_sources, redact
from tallyline.rules import vocabulary as V
from tallyline.sources.layout import write_partitioned

COUNTY = ("state", "county_name")

# fixed values: precincts filed under the wrong county (state, county, precincts, right county)
MOVED_PRECINCTS = (
    ("WISCONSIN", "BROWN", ("Village of Pulaski W4, 7",), "PULASKI"),
    ("WISCONSIN", "BROWN", ("Village of Wrightstown W4",), "OUTAGAMIE"),
    ("WISCONSIN", "DANE", ("V Brooklyn Wd 2", "V Belleville Wd 3"), "GREEN"),
    ("WISCONSIN", "DANE", ("V Cambridge Wd 1",), "JEFFERSON"),
    ("WISCONSIN", "PIERCE", ("Village of Spring Valley, Ward 3", "City of River Falls, Wards 1-4,15"), "ST CROIX"),
)
NO_VOTE = ("UNDERVOTE", "OVERVOTE", "NOT QUALIFIED")


def reallocate_precincts(df: DataFrame, moves: Sequence[tuple] = MOVED_PRECINCTS) -> DataFrame:
    """Move listed precincts to their county; the state is tested, nulls never match."""
    county = F.col("county_name")
    for state, wrong, precincts, right in reversed(moves):
        listed = holds((F.col("state") == state) & (F.col("county_name") == wrong)) & is_in("precinct", precincts)
        county = F.when(listed, F.lit(right)).otherwise(county)
    moved = df.withColumn("county_name", county)
    states = sorted({m[0] for m in moves})
    if "jurisdiction_name" not in df.columns:
        return moved
    return moved.withColumn(
        "jurisdiction_name", replace_where("jurisdiction_name", is_in("state", states), F.col("county_name"))
    )


def add_party(df: DataFrame, missing: DataFrame, check: bool = True) -> DataFrame:
    """Two spelling fixes, then fill party where the ballots leave it open."""
    name_fix = (
        (F.col("state") == "OHIO") & (F.col("office") == "STATE HOUSE")
        & (F.col("district") == "053") & (F.col("candidate") == "THOMAS HELL")
    )
    district_fix = (F.col("state") == "MICHIGAN") & (F.col("county_name") == "MASON") & (F.col("district") == "103")
    fixed = df.withColumns(
        {
            "candidate": replace_where("candidate", name_fix, F.lit("THOMAS HALL")),
            "district": replace_where("district", district_fix, F.lit("101")),
        }
    )
    return fill(fixed, missing, ["state", "office", "candidate", "district"], "party_detailed", check)


def short_party(candidate: Column, party: Column) -> Column:
    """Party code of a choice; none for no-votes and write-ins, OTH for the rest."""
    code = F.coalesce(recode(party, V.SHORT_PARTY, keep_unmatched=False), F.lit("OTH"))
    return F.when(~(is_in(candidate, NO_VOTE) | holds(party == "WRITEIN")), code)


def format_release(df: DataFrame) -> DataFrame:
    """One spelling for write-ins and no-votes, plus the short party."""
    plain = drop_matching(df, "jurisdiction_", "issue", "^n$")
    dropped = (
        is_in("candidate", ("KANYE WEST", "JOE MCHUGH ELIZABETH STORM"))
        & F.col("party_detailed").isNull()
        & holds((F.col("state") == "UTAH") & (F.col("county_name") == "SAN JUAN"))
    )
    written = (F.col("candidate") == "WRITE-IN") | (F.col("party_detailed") == "W-I")
    # an unknown party of another candidate stays unknown either way
    named = plain.where(~dropped).withColumns(
        {
            "party_detailed": F.when(written, "WRITEIN").otherwise(F.col("party_detailed")),
            "candidate": recode("candidate", {"WRITE-IN": "WRITEIN", "NO SELECTION": "UNDERVOTE"}),
        }
    )
    unified = named.withColumn(
        "party_detailed", if_else(F.col("candidate") == "WRITEIN", F.lit("WRITEIN"), F.col("party_detailed"))
    ).withColumn("party", short_party(F.col("candidate"), F.col("party_detailed")))
    before = unified.columns[unified.columns.index("party_detailed") - 1]
    return reorder(unified, ["party"], after=before)


def fill_magnitude(df: DataFrame) -> DataFrame:
    """Unknown seats: 1, two in one state's lower house, open in another's."""
    unknown = F.col("magnitude").isNull() | (F.col("magnitude") == -1)
    house = holds(F.col("office") == "STATE HOUSE")
    multi = is_in("state", ("ARIZONA", "WEST VIRGINIA")) & house
    arizona = is_in("state", ("ARIZONA",)) & house
    seats = F.when(unknown & ~multi, F.lit(1)).when(unknown & arizona, F.lit(2)).otherwise(F.col("magnitude"))
    return df.withColumn("magnitude", seats)


def twice_listed(df: DataFrame, where: Column, district: str) -> DataFrame:
    """Choices of voters listed twice for one office, in the wrong district."""
    return keep_group_size(df.where(where), [*COUNTY, "cvr_id"], F.col("__n") == 2).where(F.col("district") == district)


def coalesce_teams(
    first: DataFrame,
    second: DataFrame,
    removed: DataFrame,
    swapped: DataFrame,
    missing_party: DataFrame,
    precincts: DataFrame,
) -> DataFrame:
    """Release candidates: the first team's counties, some taken from the second.

    Both branches are one plan with one write; each county comes from exactly
    one team.
    """
    # only one office of one county is corrected; all other ballots pass by
    slip = holds((F.col("state") == "OHIO") & (F.col("county_name") == "SENECA") & (F.col("office") == "STATE HOUSE"))
    wrong = twice_listed(first, slip, "087")
    keys = [*COUNTY, "cvr_id", "office", "district"]
    own = first.where(~slip).unionByName(first.where(slip).join(wrong.select(*keys), keys, "left_anti"))
    ready = add_party(
        reallocate_precincts(
            own.join(removed.select(*COUNTY), list(COUNTY), "left_anti").join(swapped.select(*COUNTY), list(COUNTY), "left_anti")
        ),
        missing_party,
    )
    taken = second.join(swapped.select(*COUNTY), list(COUNTY), "left_semi")
    both = format_release(ready).unionByName(format_release(taken), allowMissingColumns=True)
    return checked_join(fill_magnitude(both), precincts, [*COUNTY, "precinct"], "left", "many-to-one")


def subset_release(coalesced: DataFrame, county: DataFrame, groups: DataFrame) -> DataFrame:
    """Releasable counties with small precincts replaced by their privacy group."""
    chosen = county.where(F.col("release") == 1).select(*COUNTY)
    kept = drop_matching(coalesced.join(chosen, list(COUNTY), "left_semi"), "contest")
    listed = drop_matching(groups, "style").withColumn("cvr_id", F.col("cvr_id").try_cast("bigint"))
    keys = [*COUNTY, "cvr_id", "precinct_cvr", "precinct_returns"]
    labels = {"precinct_returns": "precinct_returns_group", "precinct_cvr": "precinct_cvr_group"}
    covered = redact(kept, listed, keys, labels)
    return reorder(covered, ["precinct_returns", "precinct_cvr"], after="precinct").drop("precinct")


def write_release(release: DataFrame, path: str) -> None:
    write_partitioned(release, path, COUNTY, "replace")


def repeated_ballots(release: DataFrame, office: str) -> DataFrame:
    """How often a voter occurs in one office: ``n`` (times) and ``nn`` (voters).

    The check runs on (state, county, voter); senate seats of a state with two
    contests also by district, multi-member lower houses not at all.
    """
    rows = release.where(F.col("office") == office)
    voter = [*COUNTY, "cvr_id"]
    if office == "US SENATE":
        seat = F.when(F.col("state") == "GEORGIA", F.col("district"))
        return count_of_counts(rows.withColumn("__seat", seat), [*voter, "__seat"])
    if office == "STATE HOUSE":
        rows = rows.where(not_in("state", ("WEST VIRGINIA", "ARIZONA")))
    return count_of_counts(rows, voter)


class RepeatedBallots(ValueError):
    """A voter occurs more than once in an office."""


def _checked(offices: Sequence[str]) -> Column:
    """Rows of which a voter may have one per office: multi-member lower houses are left out."""
    several = (F.col("office") == "STATE HOUSE") & is_in("state", ("WEST VIRGINIA", "ARIZONA"))
    return is_in("office", offices) & ~holds(several)


def _seat() -> Column:
    """The senate seat where a state elects two."""
    return F.when((F.col("office") == "US SENATE") & (F.col("state") == "GEORGIA"), F.col("district"))


def check_release(release: DataFrame, offices: Sequence[str] = tuple(V.OFFICES)) -> None:
    """Every voter occurs exactly once per office, or an error names the office.

    The whole release is read once: voters are counted per office, then the
    counts of all offices come back as one small table.
    """
    rows = release.where(_checked(offices)).withColumn("__seat", _seat())
    counts = tally(rows, ["office", *COUNTY, "cvr_id", "__seat"])
    worst = counts.groupBy("office").agg(F.max("n").alias("n")).where("n > 1").collect()
    if worst:
        raise RepeatedBallots(", ".join(f"{r['office']}: {r['n']} times" for r in worst))


_REFUSED = "release refused: "
#: Tasks the rows without a voter number are spread over.
NAMELESS_TASKS = 1024


def publish_release(release: DataFrame, path: str, offices: Sequence[str] = tuple(V.OFFICES)) -> dict[str, int]:
    """Check the release while it is written; only a release that holds replaces its partitions.

    The rules are those of :func:`check_release`, and a checked row without a
    voter number is refused as well, since it cannot be shown to be the only
    one.  Rows are dealt by voter and counted in the write's own plan, so the
    release is computed once and never read back.  A row that breaks a rule
    fails its task before the job commits: what ``path`` held stays as it was,
    and :class:`RepeatedBallots` names the office.  Returned are the checked
    rows written per office, which is also their number of voters, observed by
    the write; an office without rows has 0, an empty release writes nothing.

    A window holds a voter's rows of one office.  Only a broken release has
    many there; its task spills, and the release is refused.
    """
    checked, named = _checked(offices), F.col("cvr_id").isNotNull()
    # rows that no rule compares need not meet
    spread = F.when(~named, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in release.columns]), F.lit(NAMELESS_TASKS)))
    voter = Window.partitionBy("office", *COUNTY, "cvr_id", _seat(), spread)
    counted = release.withColumn("__times", F.count(F.lit(1)).over(voter))
    reason = F.when(~named, F.lit("no voter number")).otherwise(F.concat(F.col("__times").cast("string"), F.lit(" times")))
    refusal = F.raise_error(F.concat(F.lit(_REFUSED), "office", F.lit(": "), reason, F.lit(";")))
    broken = checked & (~named | (F.col("__times") > 1))
    single = counted.where(F.when(broken, refusal.cast("boolean")).otherwise(F.lit(True))).drop("__times")
    written = [F.count_if(checked & (F.col("office") == office)).alias(office) for office in offices]
    try:
        return write_partitioned(single, path, COUNTY, "replace", written)
    except PySparkException as error:
        if _REFUSED not in str(error):
            raise
        raise RepeatedBallots(str(error).split(_REFUSED, 1)[1].split(";", 1)[0]) from error


def released_counties(release: DataFrame) -> DataFrame:
    return release.select(*COUNTY).distinct().orderBy(*COUNTY)


def party_frequency(release: DataFrame) -> DataFrame:
    return tally(release, ["party"])


def source_precedence(first: DataFrame, second: DataFrame, swapped: DataFrame, removed: DataFrame) -> DataFrame:
    return prefer_sources(first, second, COUNTY, swapped, removed)


def shown_count(c: str) -> Column:
    return comma_number(c)
