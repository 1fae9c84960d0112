"""County ballots -> the long ballot table.

One row per voter, contest and choice with fixed columns.  Each reader hands
over either a wide table (a column per contest) or a long one; both end in
:func:`clean`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.nulls import any_of, col, first_match, holds, is_in
from tallyline.functions.text import (
    detect, drop_non_ascii, extract, null_tokens, pad_left, remove_all, squish,
)
from tallyline.operators.columns import (
    add_literals, add_missing, apply_across, drop_known, rename, rename_aliases, select_optional,
)
from tallyline.operators.groups import first_per_key, with_group_stats
from tallyline.operators.joins import metadata_wins
from tallyline.plans.parties import (
    final_text, party_from_marks, president_name, president_party, unify_writein, without_noise,
)
from tallyline.rules import vocabulary as V
from tallyline.sources.delimited import number_rows

BALLOT_KEYS = ("state", "county_name", "cvr_id")
LONG_COLUMNS = (
    "state", "county_name", "jurisdiction_name", "cvr_id", "precinct", "office", "district",
    "candidate", "party_detailed", "magnitude", "contest",
)


def pad_districts(office: Column | str, district: Column | str) -> Column:
    """Three digits for district offices, as printed elsewhere."""
    return F.when(is_in(office, V.DISTRICT_OFFICES), pad_left(district, 3)).otherwise(col(district))


def contest_lookup(contests: DataFrame, state: str | None = None, county: str | None = None) -> DataFrame:
    """The hand-made contest table made joinable: upper case, padded, tokens filled.

    Restricted to one county where named; Alaska's rows serve any county.  Long
    ballots meet such a county's lookup in a broadcast join: it has a row per contest
    and choice, and a shuffle would gather a contest's ballots in one task.
    """
    rows = apply_across(contests, contests.columns, null_tokens)
    rows = rows.withColumn("county_name", F.coalesce("county_name", F.lit("")))
    if state is not None:
        rows = rows.where((F.col("state") == state) & ((F.col("county_name") == county) | (F.col("state") == "ALASKA")))
    rows = rows.where(F.col("contest").isNotNull())
    rows = apply_across(rows, [c for c in rows.columns if c != "contest"], F.upper)
    district = pad_districts("office", "district")
    return rows.withColumns(
        {
            "district": F.replace(
                F.replace(district, F.lit("COUNTY_NAME"), F.col("county_name")), F.lit("STATEWIDE"), F.col("state")
            ),
            "contest": drop_non_ascii("contest"),
        }
    )


def party_lookup(raw: DataFrame, candidate: str = "candidate") -> DataFrame:
    """The hand-made party table made joinable; ``candidate`` names its name column."""
    rows = apply_across(raw.where(F.col(candidate).isNotNull()), raw.columns, F.upper)
    rows = rows.withColumnRenamed(candidate, "candidate")
    rows = rows.withColumn("district", pad_districts("office", "district"))
    return rows.select("state", "office", "district", "candidate", "party_detailed", "issue").distinct()


def is_blank_cell(cell: Column | str) -> Column:
    """A cell that shows no vote: 0, redacted, or an undervote label; null if missing."""
    return col(cell).isin("0", *V.REDACTED_CELLS) | detect(cell, "undervote")


def choice_from_cell(cell: Column | str, named: Column | str, voted: Column) -> Column:
    """Candidate of a 0/1 (or named) cell once it is known whether a vote was cast."""
    return first_match(
        [
            (~voted & is_in(cell, V.REDACTED_CELLS), F.lit(None).cast("string")),
            (~voted, F.lit("undervote")),
            (col(cell) == "0", F.lit(None).cast("string")),
        ],
        F.coalesce(col(named), col(cell)),
    )


def infer_undervotes(
    long: DataFrame, cell: str, named: str, keys: Sequence[str] = (*BALLOT_KEYS, "office", "district")
) -> DataFrame:
    """Undervotes of long 0/1 rows: no cell of a voter's contest shows a vote.

    Adds ``voted`` and ``candidate``; null keys form their own group.
    """
    flagged = with_group_stats(long, list(keys), voted=F.bool_or(holds(~is_blank_cell(cell))))
    return flagged.withColumn("candidate", choice_from_cell(cell, named, F.col("voted")))


def _contest_columns(
    wide: DataFrame, lookup: DataFrame, ids: Sequence[str]
) -> tuple[list[str], list[str], dict[tuple, list[tuple[str, int, tuple]]]]:
    """Columns that identify a ballot, those the lookup carries, and the cells of each (office, district).

    The lookup is no longer than the file is wide, so it is read to the driver.
    A cell is (column, its place in the file, its entry of the lookup); cells
    are listed in the file's order, entries of one column in that of their values.
    """
    kept = [c for c in ids if c in wide.columns]
    cells = [c for c in wide.columns if c not in kept]
    carried = [c for c in lookup.columns if c not in ("state", "county_name", "contest")]
    named = {}
    for row in lookup.select("contest", *carried).where(F.col("contest").isin(cells)).collect():
        named.setdefault(row["contest"], []).append(tuple(row[c] for c in carried))
    if not named:
        raise ValueError("no column of the file is a contest of the lookup")
    at = {c: k for k, c in enumerate(carried)}

    def by_value(entry: tuple) -> list[tuple]:
        rest = [v for c, v in zip(carried, entry) if c != "candidate"]
        return [(v is not None, v or "") for v in [*rest, entry[at["candidate"]]]]

    contests: dict[tuple, list[tuple[str, int, tuple]]] = {}
    for place, cell in enumerate(cells):
        for entry in sorted(named.get(cell, ()), key=by_value):
            contests.setdefault((entry[at["office"]], entry[at["district"]]), []).append((cell, place, entry))
    return kept, carried, contests


def unpivot_ballots(
    wide: DataFrame, lookup: DataFrame, ids: Sequence[str] = ("state", "county_name", "cvr_id", "precinct")
) -> DataFrame:
    """Wide ballots -> long choices with undervotes, without a shuffle.

    A ballot is one wide row, so whether a vote was cast in a contest is an
    expression over that row's cells, grouped by (office, district) and joined
    to the lookup as literals.  Extra lookup columns are carried along, and
    ``__pos`` holds the place of the column in the file.
    """
    kept, carried, contests = _contest_columns(wide, lookup, ids)
    # a missing cell is no row of the long table, so it decides nothing
    voted = F.array(*[any_of([holds(~is_blank_cell(f"`{c}`")) for c, _, _ in cells]) for cells in contests.values()])
    literal = wide.sparkSession.createDataFrame(
        [(cell, *entry, k, place) for k, cells in enumerate(contests.values()) for cell, place, entry in cells],
        ", ".join(["contest string", *[f"`{c}` string" for c in carried], "__k int", "__pos int"]),
    ).withColumnRenamed("candidate", "__named")
    used = {cell for cells in contests.values() for cell, _, _ in cells}
    flagged = wide.select(*kept, voted.alias("__voted"), *[F.col(f"`{c}`") for c in wide.columns if c in used])
    long = flagged.unpivot([*kept, "__voted"], None, "contest", "__cell").where(F.col("__cell").isNotNull())
    joined = long.join(F.broadcast(literal), "contest")  # as long as the file is wide
    choice = choice_from_cell("__cell", "__named", F.col("voted"))
    return (
        joined.withColumn("voted", F.element_at("__voted", F.col("__k") + 1))
        .withColumn("candidate", choice)
        .drop("__voted", "__k", "__cell", "__named")
    )


def single_choices(
    wide: DataFrame, lookup: DataFrame, ids: Sequence[str] = ("state", "county_name", "cvr_id", "precinct")
) -> DataFrame:
    """Wide ballots -> long choices, each choice of a contest once: that of the first column.

    For files whose rows are single ballots.  All choices of a ballot stand in
    its row, so repeats are found there, among the cells of a contest, and no
    choice is shuffled.  Missing cells and cells that are no choice give no row.
    """
    kept, carried, contests = _contest_columns(wide, lookup, ids)
    named = carried.index("candidate")
    cells = F.array(*[
        F.array(*[F.struct(F.col(f"`{c}`").alias("cell"), F.lit(entry[named]).cast("string").alias("named")) for c, _, entry in listed])
        for listed in contests.values()
    ])
    # one step per value used more than once, so that no lambda computes it again for every cell
    marked = F.transform(cells, lambda of: F.struct(of.alias("of"), F.exists(of, lambda x: holds(~is_blank_cell(x["cell"]))).alias("voted")))
    chosen = F.transform(marked, lambda m, k: F.struct(
        F.transform(m["of"], lambda x: F.when(x["cell"].isNotNull(), choice_from_cell(x["cell"], x["named"], m["voted"]))).alias("choices"),
        k.alias("k"),
    ))
    firsts = F.flatten(F.transform(chosen, lambda c: F.transform(
        F.filter(F.array_distinct(c["choices"]), lambda choice: choice.isNotNull()),
        lambda choice: F.struct(c["k"].alias("k"), F.array_position(c["choices"], choice).alias("p"), choice.alias("candidate")),
    )))
    others = [c for c in carried if c != "candidate"]
    literal = wide.sparkSession.createDataFrame(
        [
            (k, p, cell, *[v for c, v in zip(carried, entry) if c != "candidate"])
            for k, listed in enumerate(contests.values())
            for p, (cell, _, entry) in enumerate(listed, 1)
        ],
        ", ".join(["__k int", "__p long", "contest string", *[f"`{c}` string" for c in others]]),
    )
    long = wide.select(*kept, F.explode(firsts).alias("__one")).select(
        *kept, F.col("__one.k").alias("__k"), F.col("__one.p").alias("__p"), F.col("__one.candidate").alias("candidate")
    )
    return long.join(F.broadcast(literal), ["__k", "__p"]).drop("__k", "__p")  # as long as the file is wide


#: Column of a ballot number given by the reader.
NUMBERED = "__number"


def prepare_wide(raw: DataFrame, state: str, county: str) -> DataFrame:
    """Canonical precinct column, no metadata columns, literal keys, ballot number.

    The ballot number is the row's place over all files of the county; a reader
    that numbered them already gave it as :data:`NUMBERED`.
    """
    renamed = rename_aliases(raw, "precinct", V.PRECINCT_ALIASES)
    named = add_literals(renamed, state=state, county_name=county)
    if NUMBERED in raw.columns:
        numbered = named.withColumnRenamed(NUMBERED, "cvr_id")
    else:
        numbered = number_rows(named, "cvr_id", scope=["state", "county_name"])
    return drop_known(numbered, (*V.METADATA_COLUMNS, "__file", "__block", "__spot"))


def clean_text(df: DataFrame) -> DataFrame:
    """Candidate and party from printed text, in two passes around the noise removal."""
    first = df.withColumn("party_detailed", party_from_marks("party_detailed", "candidate"))
    upper = first.withColumn("candidate", without_noise("candidate"))
    second = upper.withColumn("party_detailed", party_from_marks("party_detailed", "candidate"))
    bare = remove_all("candidate", V.MARKS_REMOVED, ignore_case=True)
    named = second.withColumn("candidate", president_name("office", "candidate", bare))
    no_choice = F.when(~detect("candidate", V.NO_CHOICE), F.col("party_detailed"))
    party = president_party("office", "candidate", no_choice)
    return named.withColumn("party_detailed", party).withColumn(
        "candidate", unify_writein(final_text("candidate"))
    )


def _finish(df: DataFrame) -> DataFrame:
    with_precinct = add_missing(df, ["precinct"])
    alaska = F.upper(extract("precinct", r"District \d+"))
    jurisdiction = F.when(F.col("state") == "ALASKA", alaska).otherwise(F.col("county_name"))
    finished = with_precinct.withColumn("jurisdiction_name", jurisdiction)
    if "precinct" not in df.columns:
        finished = finished.drop("precinct")
    return select_optional(finished, LONG_COLUMNS)


def clean(df: DataFrame, order: Sequence[str] = ("contest",)) -> DataFrame:
    """Labelled choices -> the long ballot table.

    Drops choices without office or candidate, keeps one row per voter, contest
    and choice (the first in ``order``), then standardises the text.
    """
    known = df.dropna(subset=["office", "candidate"])
    single = first_per_key(known, [*BALLOT_KEYS, "office", "district", "candidate"], order)
    return _finish(clean_text(single))


def clean_wide(raw: DataFrame, state: str, county: str, contests: DataFrame) -> DataFrame:
    """Wide delimited file of a county -> long ballot table, without a shuffle of choices."""
    wide = prepare_wide(raw, state, county)
    single = single_choices(wide, contest_lookup(contests, state, county))
    return _finish(clean_text(single.dropna(subset=["office"])))


def clean_labelled(df: DataFrame, state: str, county: str, contests: DataFrame) -> DataFrame:
    """Already long ballots (JSON, XML, one-choice-per-row files) -> long ballot table.

    The lookup's candidate wins over the printed one; party and magnitude of
    the source win over the lookup's.
    """
    lookup = contest_lookup(contests, state, county).drop("state", "county_name")
    shared = [c for c in ("candidate", "party_detailed", "magnitude") if c in df.columns]
    renamed = rename(lookup, **{f"__{c}": c for c in shared})
    joined = add_literals(df, state=state, county_name=county).join(F.broadcast(renamed), "contest", "left")
    merged = {c: F.coalesce(f"__{c}", c) if c == "candidate" else F.coalesce(c, f"__{c}") for c in shared}
    return clean(joined.withColumns(merged).drop(*[f"__{c}" for c in shared]))


def vote_partition(marks: DataFrame, keys: Sequence[str] = ("cvr_id",), contest: str = "contest") -> DataFrame:
    """Marks -> valid votes, undervotes, overvotes (disjoint per voter and contest).

    A valid vote is an unambiguous mark.  A contest with none becomes one
    UNDERVOTE row (ambiguous marks are ignored unless all are) and/or one
    OVERVOTE row per distinct magnitude, as the counters say.
    """
    group = [*keys, contest]
    choices = [c for c in ("precinct", "magnitude") if c in marks.columns]
    party = [c for c in ("party_detailed",) if c in marks.columns]
    valid = F.col("isVote") & ~F.col("isAmbiguous")
    under, over = F.col("undervotes") > 0, F.col("overvotes") > 0
    votes = marks.where(valid).select(*group, *choices, "candidate", *party, F.lit("VALID").alias("vote_class"))
    # one exchange: a set holds only what differs between the marks of a contest and is combined map-side
    clear = holds(under & ~F.col("isAmbiguous"))
    row = F.struct(*choices, holds(under).alias("__under"), clear.alias("__clear"), holds(over).alias("__over"))
    contests = marks.groupBy(*group).agg(
        F.bool_or(valid).alias("__valid"),
        F.bool_and(F.when(under, F.col("isAmbiguous"))).alias("__all"),  # only marks of undervoted contests
        F.collect_set(row).alias("__rows"),
    ).where(~F.col("__valid"))

    def labelled(label: str, kept) -> Column:
        rows = F.filter("__rows", kept)
        return F.array_distinct(F.transform(rows, lambda r: F.struct(*[r[c].alias(c) for c in choices], F.lit(label).alias("candidate"))))

    undervotes = labelled("UNDERVOTE", lambda r: r["__clear"] | (r["__under"] & F.coalesce(F.col("__all"), F.lit(False))))
    overvotes = labelled("OVERVOTE", lambda r: r["__over"])
    blanks = contests.select(*group, F.explode(F.concat(undervotes, overvotes)).alias("r")).select(
        *group, *[F.col(f"r.{c}").alias(c) for c in [*choices, "candidate"]]
    )
    return votes.unionByName(blanks.withColumn("vote_class", F.col("candidate")), allowMissingColumns=True)


def _voted_or_blank(marks: DataFrame, contest: Sequence[str]) -> DataFrame:
    """One row per voter, contest and choice; a contest without a ``__vote`` has the one choice ``undervote``.

    The vote flag and the choices of a contest are folded together, so ballots
    are shuffled once.  A set holds only what differs between the marks of a
    contest and is combined map-side: many rows with the same voter, or with none, add
    nothing to it.  Of equal choices the first contest name stays; null choices go.
    """
    rest = [c for c in marks.columns if c not in (*contest, "contest", "candidate", "__vote")]
    fields = ["contest", *rest]
    folded = marks.groupBy(*contest).agg(
        F.bool_or("__vote").alias("__voted"), F.sort_array(F.collect_set(F.struct("candidate", *fields))).alias("__marks")
    )
    first = F.filter(
        "__marks", lambda m, k: m["candidate"].isNotNull()
        & ~F.coalesce(F.get("__marks", k - 1)["candidate"] == m["candidate"], F.lit(False)),
    )
    blank = F.array_min(F.transform("__marks", lambda m: F.struct(F.lit("undervote").alias("candidate"), *[m[c].alias(c) for c in fields])))
    kept = folded.select(*contest, F.explode(F.when(F.col("__voted"), first).otherwise(F.array(blank))).alias("__mark"))
    return kept.select(*contest, *[F.col(f"__mark.{c}").alias(c) for c in ("candidate", *fields)])


def clean_race_export(raw: DataFrame, state: str, county: str, contests: DataFrame) -> DataFrame:
    """One-race-per-file export (voter, precinct, race, choice) -> long ballot table."""
    named = raw.select(
        F.col("cid").alias("cvr_id"), F.col("Precinct").alias("precinct"),
        F.col("Race").alias("contest"), F.col("Candidate").alias("__cell"),
    )
    lookup = rename(contest_lookup(contests, state, county).drop("state", "county_name"), __named="candidate")
    joined = add_literals(named.join(F.broadcast(lookup), "contest", "left"), state=state, county_name=county).dropna(subset=["office"])
    no_vote = (F.col("__cell") == "0") | detect("__cell", "undervote")
    chosen = first_match(
        [(detect("__cell", "undervote"), F.lit("undervote")), (F.col("__cell") == "0", F.lit(None).cast("string"))],
        F.coalesce(F.col("__named"), F.col("__cell")),
    )
    marks = joined.withColumns({"candidate": chosen, "__vote": ~F.coalesce(no_vote, F.lit(False))})
    single = _voted_or_blank(marks.drop("__cell", "__named"), [*BALLOT_KEYS, "office", "district"])
    party = party_from_marks("party_detailed", "candidate", V.RACE_EXPORT_PARTY_MARKS)
    bare = remove_all("candidate", V.RACE_EXPORT_MARKS_REMOVED, ignore_case=True)
    labelled = single.withColumn("party_detailed", party).withColumn(
        "candidate", president_name("office", "candidate", bare)
    )
    standard = labelled.withColumn("party_detailed", president_party("office", "candidate", F.col("party_detailed")))
    text = without_noise("candidate", V.TEXT_NOISE + "|^ | $")
    return _finish(standard.withColumn("candidate", text))


def clean_vote_flags(raw: DataFrame, state: str, county: str, contests: DataFrame) -> DataFrame:
    """Export with a row per offered choice and an ``IsVote`` flag."""
    marked = raw.where(F.col("IsVote").try_cast("boolean")).select(
        F.col("CVRNumber").alias("cvr_id"), F.col("Contest").alias("contest"), squish("Candidate").alias("candidate")
    )
    return clean_labelled(marked, state, county, contests)


def clean_stacked_export(raw: DataFrame, state: str, county: str, contests: DataFrame) -> DataFrame:
    """Stacked files (cvrNumber, precinct, contest, candidate): printed party is not used."""
    named = raw.select(F.col("cvrNumber").alias("cvr_id"), "precinct", "contest", "candidate")
    lookup = contest_lookup(contests, state, county).drop("state", "county_name", "candidate", "party_detailed").distinct()
    joined = add_literals(named.join(F.broadcast(lookup), "contest", "left"), state=state, county_name=county)
    printed = joined.withColumn("candidate", without_noise("candidate"))
    party = F.when(F.col("contest") == "PROPOSITION", F.lit("NONPARTISAN"))
    labelled = printed.withColumn("candidate", president_name("office", "candidate", F.col("candidate")))
    standard = labelled.withColumn("party_detailed", president_party("office", "candidate", party))
    return _finish(standard.withColumn("candidate", unify_writein(final_text("candidate"))))


def discover_contests(tables: Sequence[tuple[str, str, str, DataFrame]], column: str | None = None) -> DataFrame:
    """Contest names per county: header names of wide files, or a column's values.

    ``tables`` holds (state, county, type, table).  Metadata columns are left out.
    """
    known = (*V.METADATA_COLUMNS, *V.PRECINCT_ALIASES, "__file", "__block", "__spot")
    found = None
    for state, county, kind, table in tables:
        if kind == "delim":
            names = [(state, county, kind, c) for c in table.columns if c not in known]
            rows = table.sparkSession.createDataFrame(names, "state string, county_name string, type string, contest string")
        else:
            rows = add_literals(
                table.select(F.col(column or "contest").alias("contest")).distinct(), state=state, county_name=county, type=kind
            ).where(~is_in("contest", known))
            rows = rows.select("state", "county_name", "type", "contest")
        found = rows if found is None else found.unionByName(rows)
    return found


def merge_party(pass1: DataFrame, metadata: DataFrame) -> DataFrame:
    """Second pass: metadata party wins, flagged candidates go."""
    return metadata_wins(pass1, metadata, ["state", "office", "district", "candidate"], "party_detailed")

