"""Queries that write the tables in a source's format and read them back.

The files lie in the shared folder of the session; every query starts from the
given tables and compares with the tables themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.catalog import comparing
from tallyline.catalog.base import query
from tallyline.catalog.domain import _COLUMNS, _MATRIX, _matrix_cells
from tallyline.catalog.roles import ballots, table, with_ballots, with_returns
from tallyline.functions.nulls import first_match
from tallyline.operators import groups as G
from tallyline.plans import cleaning as K
from tallyline.plans import compare as C
from tallyline.plans.build import build_ballots
from tallyline.session import scratch_path, shuffles_freed, written_once
from tallyline.sources import delimited as D
from tallyline.sources import layout as Y
from tallyline.sources import nested as M
from tallyline.sources import records as R


@query(
    "typed_csv",
    """SELECT c_custkey, nullif(c_name, 'Customer#000000007') AS c_name, CASE WHEN c_custkey % 4 > 1 THEN c_mktsegment END AS c_mktsegment,
  c_nationkey, c_acctbal FROM customer""",
)
def typed_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "typed")
    key = F.col("c_custkey") % 4
    segment = F.when(key == 0, "NA").when(key == 1, "#N/A").otherwise(F.concat(F.lit(" "), "c_mktsegment"))
    rows = table(spark, folder, "customer").withColumns(
        {"c_mktsegment": segment, "c_name": F.nullif("c_name", F.lit("Customer#000000007"))}
    )
    rows.write.option("header", True).csv(path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return D.read_typed_csv(spark, path, schema)


@query(
    "hive_partitions",
    with_ballots(
        """SELECT state, county_name, count(*) AS n, CAST(sum(qty) AS BIGINT) AS qty FROM (
  SELECT state, CASE WHEN nk = 4 THEN 'PRINCE GEORGE''S' ELSE county_name END AS county_name, nk, choice_no, qty FROM ballots) t
WHERE (nk % 5 <> 2 OR choice_no < 4) AND state <> 'ASIA' GROUP BY 1, 2"""
    ),
)
def hive_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Write by county, replace some counties, read back with a pruning filter."""
    path = scratch_path(spark, "hive")
    county = F.when(F.col("nk") == 4, "PRINCE GEORGE'S").otherwise(F.col("county_name"))
    rows = ballots(spark, folder).select("state", county.alias("county_name"), "nk", "choice_no", "qty")
    Y.write_partitioned(rows, path, ["state", "county_name"], "overwrite")
    Y.write_partitioned(rows.where("nk % 5 = 2 AND choice_no < 4"), path, ["state", "county_name"], "replace")
    stored = Y.read_partitioned(spark, path).where("state <> 'ASIA'")
    return stored.groupBy("state", "county_name").agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("qty"))


@query(
    "drifting_schema",
    """SELECT region, count(*) AS n, count(balance) AS n_balance, count(segment) AS n_segment FROM (
  SELECT 'c' AS region, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT 's', s_acctbal, NULL FROM supplier) t
GROUP BY region""",
)
def drifting_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Files of differing columns below one root, read by a glob under a declared schema."""
    path = scratch_path(spark, "drift")
    customers = table(spark, folder, "customer").select(F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, folder, "supplier").select("s_name", F.col("s_acctbal").alias("balance"))
    customers.write.parquet(f"{path}/region=c")
    suppliers.write.parquet(f"{path}/region=s")
    rows = Y.read_partitioned(spark, f"{path}/*/*.parquet", "balance double, segment string, region string", base=path)
    return rows.groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.count("balance").alias("n_balance"), F.count("segment").alias("n_segment")
    )


def _wide_files(spark: SparkSession, folder: str) -> str:
    """The 0/1 matrix as delimited files with vendor metadata columns."""
    path = scratch_path(spark, "wide")
    wide = _matrix_cells(spark, folder).groupBy("cvr_id").pivot("contest", [f"c{k}" for k in range(1, 8)]).agg(F.first("cell"))
    named = wide.select(
        F.col("cvr_id").alias("Cvr Number"), F.lit("7").alias("Batch Id"),
        F.concat(F.lit("P,"), (F.col("cvr_id") % 5).cast("string")).alias("Precinct Portion"), *[f"c{k}" for k in range(1, 8)],
    )
    named.write.option("header", True).csv(path)
    return path


_CONTESTS = [("OHIO", "WAYNE", c, o, d, n, None, "1") for c, o, d, n in _COLUMNS]
_CONTEST_SCHEMA = (
    "state string, county_name string, contest string, office string, district string, candidate string, "
    "party_detailed string, magnitude string"
)


@query(
    "wide_ballot_files",
    f"""WITH {_MATRIX}, chosen AS (SELECT DISTINCT cvr_id, office, district, CASE WHEN NOT voted AND cell = 'X' THEN NULL
    WHEN NOT voted THEN 'UNDERVOTE' WHEN cell = '0' THEN NULL ELSE coalesce(named, upper(trim(regexp_replace(cell, '\\([^)]*\\)$|\\p{{P}}', '', 'g')))) END AS candidate
  FROM voted)
SELECT office, district, 'P,' || CAST(cvr_id % 5 AS VARCHAR) AS precinct, candidate, count(*) AS n, count(DISTINCT cvr_id) AS n_voters
FROM chosen WHERE candidate IS NOT NULL GROUP BY 1, 2, 3, 4""",
)
def wide_ballot_files(spark: SparkSession, folder: str) -> DataFrame:
    """Delimited county files all the way to the long ballot table."""
    raw = D.read_wide_ballots(spark, f"{_wide_files(spark, folder)}/*.csv")
    long = K.clean_wide(raw, "OHIO", "WAYNE", spark.createDataFrame(_CONTESTS, _CONTEST_SCHEMA))
    return long.groupBy("office", "district", "precinct", "candidate").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("cvr_id").alias("n_voters")
    )


@query(
    "numbered_rows",
    """SELECT count(*) AS n, count(*) AS n_ids, CAST(1 AS BIGINT) AS low, count(*) AS high,
  CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n_ballots FROM lineitem""",
)
def numbered_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Row numbers over several files: dense, unique, and scanned without a sort of rows."""
    path = scratch_path(spark, "numbered")
    table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber").repartition(6).write.option("header", True).csv(path)
    raw = D.read_wide_ballots(spark, f"{path}/*.csv", multi_line=False).withColumn("county_name", F.lit("ONE"))
    return D.number_rows(raw, "idx", ["county_name"]).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("idx").alias("n_ids"), F.min("idx").alias("low"),
        F.max("idx").alias("high"), F.count_distinct("l_orderkey").alias("n_ballots"),
    )


@query(
    "split_quoted_files",
    """SELECT o_orderpriority AS priority, count(*) AS n, CAST(1 AS BIGINT) AS low, count(*) AS high, count(*) AS n_ids,
  CAST(sum(o_orderkey) AS BIGINT) AS keys, CAST(sum(length(o_orderstatus || chr(10) || '"' || o_orderpriority || '"' || chr(10) || o_orderkey)) AS BIGINT) AS n_chars
FROM orders GROUP BY o_orderpriority""",
)
def split_quoted_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files with quoted line breaks and quotes, cut by ranges, numbered through all files of a folder in one batch."""
    path = scratch_path(spark, "quoted")
    note = F.concat("o_orderstatus", F.lit('\n"'), "o_orderpriority", F.lit('"\n'), F.col("o_orderkey").cast("string"))
    rows = table(spark, folder, "orders").select("o_orderkey", note.alias("note"), F.col("o_orderpriority").alias("scope_of"))
    rows.repartition(6).write.partitionBy("scope_of").option("header", True).option("escape", '"').csv(path)
    scope = F.regexp_extract(D.FILE, "/scope_of=([^/]*)/", 1)
    # a line break or quote lost, doubled or moved to another record changes keys or characters
    read = R.read_split(spark, path, scope).withColumn("priority", F.regexp_extract("note", '"([^"]*)"', 1))
    return read.groupBy("priority").agg(
        F.count(F.lit(1)).alias("n"), F.min("idx").alias("low"), F.max("idx").alias("high"), F.count_distinct("idx").alias("n_ids"),
        F.sum(F.col("o_orderkey").cast("bigint")).alias("keys"), F.sum(F.length("note")).alias("n_chars"),
    )


@query(
    "many_files",
    """SELECT kind, count(*) AS n, count(name) AS n_name, count(balance) AS n_balance FROM (
  SELECT 'customer' AS kind, c_name AS name, NULL AS balance FROM customer
  UNION ALL SELECT 'supplier', NULL, s_acctbal FROM supplier) t GROUP BY kind""",
)
def many_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "many")
    table(spark, folder, "customer").select(F.lit("customer").alias("kind"), F.col("c_name").alias("name")).write.option(
        "header", True
    ).csv(f"{path}/a")
    table(spark, folder, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance")).write.option(
        "header", True
    ).csv(f"{path}/b")
    rows = D.read_many(spark, [f"{path}/a", f"{path}/b"])
    return rows.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.count("name").alias("n_name"), F.count("balance").alias("n_balance")
    )


@query(
    "multi_header_files",
    """SELECT r_name AS state, count(*) AS n, count(*) FILTER (WHERE c_acctbal > 0) AS n_first, count(*) FILTER (WHERE c_acctbal <= 0) AS n_second
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
)
def multi_header_files(spark: SparkSession, folder: str) -> DataFrame:
    """A banner, three header rows, and the header block repeated mid-file, per state."""
    path = scratch_path(spark, "headers")
    regions = table(spark, folder, "region")
    customers = table(spark, folder, "customer").join(
        table(spark, folder, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey")),
        F.col("c_nationkey") == F.col("n_nationkey"),
    )
    one = F.when(F.col("c_acctbal") > 0, "1").otherwise("0")
    two = F.when(F.col("c_acctbal") > 0, "0").otherwise("1")
    lines = customers.select(
        F.col("r_name").alias("state"), (F.col("c_custkey") * 10).alias("at"),
        F.concat_ws(",", F.col("c_custkey").cast("string"), one, two).alias("value"),
    )
    block = ("2020 General,,", "Cvr Number,President,President", ",First Person,Second Person", ",DEM,REP")
    headers = regions.select(
        F.col("r_name").alias("state"),
        F.explode(
            F.array(
                *[F.struct(F.lit(start + k).cast("bigint").alias("at"), F.lit(v).alias("value")) for start in (-9, 1001) for k, v in enumerate(block)]
            )
        ).alias("h"),
    ).select("state", "h.at", "h.value")
    files = lines.unionByName(headers).repartition("state").sortWithinPartitions("state", "at")
    files.select("state", "value").write.partitionBy("state").text(path)
    made = []
    for row in regions.select("r_name").collect():  # one call per file, as for one county each
        part = D.read_multi_header(spark, f"{path}/state={row['r_name']}", probe=2)
        first, second = "President First Person Dem", "President Second Person Rep"
        made.append(
            part.agg(
                F.count(F.lit(1)).alias("n"), F.count_if(F.col(first) == "1").alias("n_first"),
                F.count_if(F.col(second) == "1").alias("n_second"),
            ).withColumn("state", F.lit(row["r_name"]))
        )
    return reduce(DataFrame.unionByName, made)


@query(
    "json_export",
    with_ballots(
        """SELECT contest, precinct, candidate, party_detailed, vote_class, count(*) AS n FROM (
  SELECT cvr_id, contest, precinct, candidate, party_detailed, 'VALID' AS vote_class FROM flagged WHERE vote AND NOT amb
  UNION ALL SELECT DISTINCT cvr_id, contest, precinct, 'UNDERVOTE', NULL, 'UNDERVOTE' FROM flagged
    WHERE NOT any_valid AND undervotes > 0 AND (NOT amb OR all_amb)
  UNION ALL SELECT DISTINCT cvr_id, contest, precinct, 'OVERVOTE', NULL, 'OVERVOTE' FROM flagged WHERE NOT any_valid AND overvotes > 0) t
GROUP BY 1, 2, 3, 4, 5""",
        """marks AS (SELECT DISTINCT cvr_id, office AS contest, precinct, candidate, party_detailed, qty > 25 AS vote, discount > 0.05 AS amb FROM ballots)""",
        """flagged AS (SELECT *, CASE WHEN bool_or(vote) OVER w THEN 0 ELSE 1 END AS undervotes,
    CASE WHEN count(*) OVER w > 1 THEN 1 ELSE 0 END AS overvotes, bool_or(vote AND NOT amb) OVER w AS any_valid,
    CASE WHEN bool_or(vote) OVER w THEN NULL ELSE bool_and(amb) OVER w END AS all_amb
  FROM marks WINDOW w AS (PARTITION BY cvr_id, contest))""",
    ),
)
def json_export(spark: SparkSession, folder: str) -> DataFrame:
    """A vendor's export folder (manifests and nested records) to classified votes."""
    marks = M.read_json_ballots(spark, _export_folder(spark, folder))
    votes = K.vote_partition(marks.withColumn("magnitude", F.lit("1")), keys=["cvr_id"])
    return G.tally(votes, ["contest", "precinct", "candidate", "party_detailed", "vote_class"])


def _export_folder(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "export")
    offices = ("US PRESIDENT", "US SENATE", "US HOUSE", "STATE SENATE", "STATE HOUSE", "GOVERNOR")
    parties = (("DEMOCRAT", "Democratic Party"), ("REPUBLICAN", "Republicans"), ("LIBERTARIAN", "Libertarian"))

    def manifest(name: str, entries: DataFrame) -> None:
        # one document with a list no longer than the dimension it names
        document = entries.agg(F.collect_list(F.struct("*")).alias("List")).select(F.lit("5.10").alias("Version"), "List")
        document.coalesce(1).write.json(f"{path}/{name}Manifest.json")

    with shuffles_freed(spark):
        # a mark once per contest: a ballot's lists are no longer than the vocabulary
        marks = ballots(spark, folder, by_voter=True).select(
            "cvr_id", "precinct", "office", "candidate", "party_detailed",
            (F.col("qty") > 25).alias("vote"), (F.col("discount") > 0.05).alias("ambiguous"),
        ).distinct()
        # the manifests and the records are all made from one copy
        rows = written_once(marks, "marks", "zstd")
        named = spark.createDataFrame([(k, o) for k, o in enumerate(offices)], "Id bigint, Description string")
        manifest("Contest", named.withColumn("DistrictId", F.lit(1).cast("bigint")))
        manifest("District", spark.createDataFrame([(1, "Countywide")], "Id bigint, Description string"))
        manifest("Party", spark.createDataFrame([(k, t) for k, (_, t) in enumerate(parties)], "Id bigint, Description string"))
        number = F.regexp_replace("candidate", "[^0-9]", "").cast("bigint")
        manifest(
            "Candidate",
            rows.select(number.alias("Id"), F.col("candidate").alias("Description"), F.lit("Regular").alias("Type")).distinct(),
        )
        portion = F.substring("precinct", 2, 9).cast("bigint")
        manifest("PrecinctPortion", rows.select(portion.alias("Id"), F.col("precinct").alias("Description")).distinct())
        # dealt by file once, as numbers: contests, cards and documents are grouped where the rows lie
        numbers = rows.select(
            F.floor(F.col("cvr_id") / 2000).alias("file"), "cvr_id", portion.alias("portion"),
            first_match([(F.col("office") == o, k) for k, o in enumerate(offices)]).cast("bigint").alias("contest"),
            number.alias("candidate"),
            first_match([(F.col("party_detailed") == p, k) for k, (p, _) in enumerate(parties)]).cast("bigint").alias("party"),
            "vote", "ambiguous",
        ).repartition("file")
        vote, ambiguous = F.col("vote"), F.col("ambiguous")
        mark = F.struct(
            F.col("candidate").alias("CandidateId"), F.col("party").alias("PartyId"),
            F.lit(1).alias("Rank"), ambiguous.alias("IsAmbiguous"), vote.alias("IsVote"),
        )
        contest = numbers.groupBy("file", "cvr_id", "portion", "contest").agg(
            F.when(F.bool_or(vote), 0).otherwise(1).alias("Undervotes"),
            F.when(F.count(F.lit(1)) > 1, 1).otherwise(0).alias("Overvotes"),
            F.collect_list(mark).alias("Marks"),
        )
        card = contest.groupBy("file", "cvr_id", "portion").agg(
            F.collect_list(F.struct(F.col("contest").alias("Id"), "Undervotes", "Overvotes", "Marks")).alias("Contests")
        )
        side = F.struct(
            F.col("portion").alias("PrecinctPortionId"), F.lit(True).alias("IsCurrent"),
            F.array(F.struct(F.lit(1).cast("bigint").alias("Id"), "Contests")).alias("Cards"),
        )
        # every third record was corrected: its original is no longer current
        corrected = F.col("cvr_id") % 3 == 0
        stale = side.withField("IsCurrent", F.lit(False))
        session = F.struct(
            F.lit(4).cast("bigint").alias("TabulatorId"), F.floor(F.col("cvr_id") / 100).alias("BatchId"), F.col("cvr_id").alias("RecordId"),
            F.when(corrected, stale).otherwise(side).alias("Original"), F.when(corrected, side).alias("Modified"),
        )
        # one document per file, each a bounded run of records
        documents = card.select("file", session.alias("s")).groupBy("file").agg(F.collect_list("s").alias("Sessions"))
        text = documents.select("file", F.to_json(F.struct(F.lit("5.10").alias("Version"), "Sessions")).alias("value"))
        # plain, the documents are several times as long as the tables
        text.write.option("compression", "gzip").partitionBy("file").text(f"{path}/CvrExport_1.json")
    return path


def _one_file_each(files: DataFrame, path: str) -> None:
    """Write rows (batch, ballot, value) as one file per ballot, in a folder per batch.

    Opening a file costs far more than its few bytes, so tasks are cut by the number of
    files: dealt by size alone, all of them would be written by one task.  A batch lies in
    one task, so the commit moves folders of batches, not files.
    """
    tasks = files.count() // BALLOTS_A_TASK + 1
    files.repartition(tasks, "batch").write.partitionBy("batch", "ballot").text(path)


#: Ballot files in a folder of a batch, and those written by one task.
BALLOTS_A_BATCH, BALLOTS_A_TASK = 100, 200


def _in_batches(files: DataFrame) -> DataFrame:
    """Rows (ballot, value) with a ``batch`` of about :data:`BALLOTS_A_BATCH` ballots."""
    batches = files.count() // BALLOTS_A_BATCH + 1
    return files.select(F.pmod(F.xxhash64("ballot"), F.lit(batches)).alias("batch"), "ballot", "value")


@query(
    "xml_ballots",
    """SELECT contest, candidate, precinct, count(*) AS n, count(DISTINCT s_suppkey) AS n_ballots FROM (
  SELECT s_suppkey, 'Governor of the State' AS contest, CASE WHEN s_suppkey % 4 = 0 THEN 'WRITEIN' WHEN s_suppkey % 4 = 1 THEN 'undervote'
    ELSE 'Person ' || CAST(s_suppkey % 7 AS VARCHAR) END AS candidate, 'Split ' || CAST(s_nationkey AS VARCHAR) AS precinct FROM supplier
  UNION ALL SELECT s_suppkey, 'Governor of the State', 'Other', 'Split ' || CAST(s_nationkey AS VARCHAR) FROM supplier WHERE s_suppkey % 4 > 1
  UNION ALL SELECT s_suppkey, 'Sheriff', 'Some One', 'Split ' || CAST(s_nationkey AS VARCHAR) FROM supplier) t GROUP BY 1, 2, 3""",
)
def xml_ballots(spark: SparkSession, folder: str) -> DataFrame:
    """One XML file per ballot, in sub-folders, read as rows of contest and choice; every option of a contest counts."""
    path = scratch_path(spark, "xml")
    key = F.col("s_suppkey") % 4
    option = first_match(
        [
            (key == 0, F.lit("<Option><WriteInData><Text>Someone</Text></WriteInData></Option>")),
            (key == 1, F.lit("")),
        ],
        F.concat(F.lit("<Option><Name>Person "), (F.col("s_suppkey") % 7).cast("string"), F.lit("</Name></Option><Option><Name>Other</Name></Option>")),
    )
    under = F.when(key == 1, "1").otherwise("0")
    value = F.concat(
        F.lit("<CastVoteRecord><Contests><Contest><Name>Governor of\nthe State</Name><Options>"), option,
        F.lit("</Options><Undervotes>"), under, F.lit("</Undervotes></Contest><Contest><Name>Sheriff</Name><Options><Option><Name>Some One</Name>"),
        F.lit("</Option></Options><Undervotes>0</Undervotes></Contest></Contests><PrecinctSplit><Name>Split "),
        F.col("s_nationkey").cast("string"), F.lit("</Name></PrecinctSplit></CastVoteRecord>"),
    )
    files = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("ballot"), value.alias("value"))
    _one_file_each(_in_batches(files), path)
    rows = M.read_xml_ballots(spark, path)
    return rows.groupBy("contest", "candidate", "precinct").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("cvr_id").alias("n_ballots")
    )


@query(
    "report_files",
    "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority",
)
def report_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "report")
    Y.write_report(G.tally(table(spark, folder, "orders"), ["o_orderpriority"]).orderBy("o_orderpriority"), path)
    return D.read_typed_csv(spark, path, "o_orderpriority string, n bigint")


@query(
    "comparison_files",
    with_returns(
        """SELECT 'by_cand' AS name, count(*) AS n, CAST(sum(votes_m) AS BIGINT) AS votes FROM aligned
UNION ALL SELECT 'by_cand_coalesced', count(*), CAST(sum(votes_c) AS BIGINT) FROM aligned
  WHERE (state, county_name) IN (SELECT (state, county_name) FROM aligned WHERE votes_c IS NOT NULL)
UNION ALL SELECT 'by_county', count(*), CAST(sum(uspres_votes_m) AS BIGINT) FROM county""",
        *comparing.COUNTY,
    ),
)
def comparison_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "compare")
    rows = written_once(comparing.aligned(spark, folder), "aligned")
    county = C.county_table(rows)
    Y.write_comparison(rows, county, C.coalesced_comparison(rows, county), path)
    sums = {"by_cand": "votes_m", "by_cand_coalesced": "votes_c", "by_county": "uspres_votes_m"}
    made = [
        spark.read.parquet(f"{path}/{name}").agg(F.count(F.lit(1)).alias("n"), F.sum(c).alias("votes")).withColumn("name", F.lit(name))
        for name, c in sums.items()
    ]
    return reduce(DataFrame.unionByName, made)


@query(
    "keys_from_path",
    """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'CA' ELSE 'MD' END AS state, 'El_' || c_mktsegment AS county FROM customer""",
)
def keys_from_path(spark: SparkSession, folder: str) -> DataFrame:
    even = F.col("c_custkey") % 2 == 0
    name = F.concat(
        F.lit("some/dir/"), F.when(even, "CA").otherwise("MD"), F.lit("_El_"), "c_mktsegment",
        F.when(even, "_long.dta").otherwise("_cvr_info.dta"),
    )
    state, county = Y.keys_from_path(name)
    return table(spark, folder, "customer").select("c_custkey", state.alias("state"), county.alias("county"))


@query(
    "total_row_dropped",
    """SELECT o_custkey, o_orderkey, CAST(o_orderkey % 2 AS VARCHAR) || ' of ' || o_orderstatus AS cell FROM orders o
WHERE o_orderkey <> (SELECT max(o_orderkey) FROM orders x WHERE x.o_custkey = o.o_custkey)""",
)
def total_row_dropped(spark: SparkSession, folder: str) -> DataFrame:
    cell = F.concat((F.col("o_orderkey") % 2).cast("string"), F.lit(" (50%) of "), "o_orderstatus")
    rows = table(spark, folder, "orders").select("o_custkey", "o_orderkey", cell.alias("cell"))
    return D.drop_last_row(D.fix_cells(rows, [D.MARK_WITH_SHARE], ["cell"]), "o_orderkey", ["o_custkey"])


@query(
    "discovered_contests",
    with_ballots(
        """SELECT 'A' AS state, 'X' AS county_name, 'delim' AS type, unnest(['c1', 'c2', 'c3', 'c4', 'c5', 'c6', 'c7']) AS contest
UNION ALL SELECT DISTINCT 'B', 'Y', 'xml', office || ' ' || district FROM ballots"""
    ),
)
def discovered_contests(spark: SparkSession, folder: str) -> DataFrame:
    wide = D.read_wide_ballots(spark, f"{_wide_files(spark, folder)}/*.csv")
    long = ballots(spark, folder).withColumn("contest", F.concat_ws(" ", "office", "district"))
    return K.discover_contests([("A", "X", "delim", wide), ("B", "Y", "xml", long)])


@query(
    "race_export",
    """SELECT office, candidate, party_detailed, count(*) AS n, count(DISTINCT cvr_id) AS n_voters FROM (
  SELECT DISTINCT cvr_id, office, CASE WHEN NOT voted THEN 'UNDERVOTE' WHEN race = 'Mayor' AND cell <> '0' THEN upper(regexp_replace(cell, '^DEM ', ''))
    WHEN cell <> '0' THEN 'NAMED' END AS candidate, CASE WHEN NOT voted THEN NULL WHEN race = 'Mayor' AND cell LIKE 'DEM %' THEN 'DEMOCRAT' END AS party_detailed
  FROM (SELECT *, bool_or(cell <> '0') OVER (PARTITION BY cvr_id, office) AS voted FROM (
    SELECT l_orderkey AS cvr_id, CASE WHEN l_linenumber < 4 THEN 'Mayor' ELSE 'Judge ' || CAST(l_linenumber AS VARCHAR) END AS race,
      CASE WHEN l_linenumber < 4 THEN 'MAYOR' ELSE 'JUDGE' END AS office, CASE WHEN l_quantity < 20 THEN '0' ELSE 'DEM ' || p_name END AS cell
    FROM lineitem JOIN part ON l_partkey = p_partkey) r) v) c WHERE candidate IS NOT NULL GROUP BY 1, 2, 3""",
)
def race_export(spark: SparkSession, folder: str) -> DataFrame:
    """A one-race-per-row export through its own cleaning variant."""
    lines = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    mayor = F.col("l_linenumber") < 4
    raw = lines.select(
        F.col("l_orderkey").alias("cid"), F.lit("P").alias("Precinct"),
        F.when(mayor, "Mayor").otherwise(F.concat(F.lit("Judge "), F.col("l_linenumber").cast("string"))).alias("Race"),
        F.when(F.col("l_quantity") < 20, "0").otherwise(F.concat(F.lit("DEM "), "p_name")).alias("Candidate"),
    )
    contests = [("TEXAS", "DENTON", "Mayor", "MAYOR", "1", None, None, "1")]
    contests += [("TEXAS", "DENTON", f"Judge {k}", "JUDGE", "1", "Named", None, "1") for k in range(4, 8)]
    long = K.clean_race_export(raw, "TEXAS", "DENTON", spark.createDataFrame(contests, _CONTEST_SCHEMA))
    return long.groupBy("office", "candidate", "party_detailed").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("cvr_id").alias("n_voters")
    )


@query(
    "vote_flag_export",
    """SELECT office, candidate, count(*) AS n FROM (
  SELECT DISTINCT l_orderkey, 'CLERK' AS office, upper(p_name) AS candidate FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE l_quantity > 10 AND l_linenumber < 6) t GROUP BY 1, 2""",
)
def vote_flag_export(spark: SparkSession, folder: str) -> DataFrame:
    """An export with a flag per offered choice."""
    lines = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    raw = lines.select(
        F.col("l_orderkey").alias("CVRNumber"), F.when(F.col("l_linenumber") < 6, "County Clerk").otherwise("Unknown").alias("Contest"),
        F.regexp_replace("p_name", " ", "   ").alias("Candidate"), (F.col("l_quantity") > 10).cast("string").alias("IsVote"),
    )
    contests = [("NEW JERSEY", "CUMBERLAND", "County Clerk", "CLERK", "1", None, None, "1")]
    long = K.clean_vote_flags(raw, "NEW JERSEY", "CUMBERLAND", spark.createDataFrame(contests, _CONTEST_SCHEMA))
    return G.tally(long, ["office", "candidate"])


@query(
    "stacked_export",
    """SELECT contest, office, candidate, party_detailed, count(*) AS n FROM (
  SELECT CASE WHEN l_linenumber = 1 THEN 'PROPOSITION' ELSE 'Treasurer' END AS contest, CASE WHEN l_linenumber > 1 THEN 'TREASURER' END AS office,
    upper(p_name) AS candidate, CASE WHEN l_linenumber = 1 THEN 'NONPARTISAN' END AS party_detailed
  FROM lineitem JOIN part ON l_partkey = p_partkey) t GROUP BY 1, 2, 3, 4""",
)
def stacked_export(spark: SparkSession, folder: str) -> DataFrame:
    """Stacked per-precinct files whose printed party is not used."""
    lines = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    raw = lines.select(
        F.col("l_orderkey").alias("cvrNumber"), F.lit("P").alias("precinct"),
        F.when(F.col("l_linenumber") == 1, "PROPOSITION").otherwise("Treasurer").alias("contest"), F.col("p_name").alias("candidate"),
    )
    contests = [("PENNSYLVANIA", "ALLEGHENY", "Treasurer", "TREASURER", "1", None, None, "1")]
    long = K.clean_stacked_export(raw, "PENNSYLVANIA", "ALLEGHENY", spark.createDataFrame(contests, _CONTEST_SCHEMA))
    return G.tally(long, ["contest", "office", "candidate", "party_detailed"])


@query(
    "xml_ballot_numbers",
    "SELECT s_suppkey AS ballot, row_number() OVER (ORDER BY lpad(CAST(s_suppkey AS VARCHAR), 9, '0')) AS cvr_id FROM supplier",
)
def xml_ballot_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Ballot numbers follow the order of the files' paths below the county folder."""
    path = scratch_path(spark, "xml-numbers")
    name = F.lpad(F.col("s_suppkey").cast("string"), 9, "0")
    value = F.concat(
        F.lit("<CastVoteRecord><Contests><Contest><Name>Sheriff</Name><Options><Option><Name>"), F.col("s_suppkey").cast("string"),
        F.lit("</Name></Option></Options></Contest></Contests><PrecinctSplit><Name>S</Name></PrecinctSplit></CastVoteRecord>"),
    )
    # many ballots lie in one folder of a batch
    files = table(spark, folder, "supplier").select(F.concat(F.lit("b"), F.substring(name, 1, 7)).alias("batch"), name.alias("ballot"), value.alias("value"))
    _one_file_each(files, path)
    return M.read_xml_ballots(spark, path).select(F.col("candidate").cast("bigint").alias("ballot"), "cvr_id")


@query(
    "nested_export_folders",
    "SELECT l_orderkey % 3 AS batch, count(*) AS n, count(DISTINCT l_orderkey) AS n_records FROM lineitem GROUP BY 1",
)
def nested_export_folders(spark: SparkSession, folder: str) -> DataFrame:
    """Vendor exports in sub-folders of batches, next to files that are no exports."""
    path = scratch_path(spark, "nested")
    mark = F.struct(F.col("l_linenumber").cast("bigint").alias("CandidateId"), F.lit(True).alias("IsVote"))
    # an order has at most seven lines, and a file the orders of 2,000 numbers
    card = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.collect_list(mark).alias("Marks"))
    contests = F.array(F.struct(F.lit(1).cast("bigint").alias("Id"), "Marks")).alias("Contests")
    side = F.struct(F.lit(True).alias("IsCurrent"), F.array(F.struct(F.lit(1).cast("bigint").alias("Id"), contests)).alias("Cards"))
    batch, file = (F.col("l_orderkey") % 3).alias("batch"), F.floor(F.col("l_orderkey") / 2000).alias("file")
    session = F.struct((F.col("l_orderkey") % 3).alias("BatchId"), F.col("l_orderkey").alias("RecordId"), side.alias("Original"))
    files = card.select(batch, file, session.alias("s")).groupBy("batch", "file").agg(F.collect_list("s").alias("Sessions"))
    records = written_once(files.select("batch", "file", F.to_json(F.struct("Sessions")).alias("value")), "records")
    for k in range(3):
        own = records.where(F.col("batch") == k).select("file", "value")
        own.repartition("file").write.partitionBy("file").text(f"{path}/{'sub/' * k}CvrExport_{k}.json")
    records.select("value").write.text(f"{path}/sub/NotAnExport.json")
    marks = M.read_export(spark, path)
    return marks.groupBy(F.col("batchId").alias("batch")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("recordId").alias("n_records"))


@query(
    "mixed_headers",
    """SELECT CAST(sum(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) AS BIGINT) AS ann, CAST(sum(CASE WHEN l_quantity <= 25 THEN 1 ELSE 0 END) AS BIGINT) AS bob,
  count(*) AS n, count(*) AS n_ids, max(CAST(l_linenumber AS BIGINT)) AS most FROM lineitem""",
)
def mixed_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Files of one county whose columns stand in different order: cells follow the printed name."""
    path = scratch_path(spark, "mixed")
    ann = F.when(F.col("l_quantity") > 25, "1").otherwise("0").alias("Gov Ann")
    bob = F.when(F.col("l_quantity") > 25, "0").otherwise("1").alias("Gov Bob")
    lines = table(spark, folder, "lineitem")
    lines.where("l_orderkey % 2 = 0").select(ann, bob, F.col("l_linenumber").alias("Line")).write.option("header", True).csv(f"{path}/a")
    lines.where("l_orderkey % 2 = 1").select(F.col("l_linenumber").alias("Line"), bob, ann).write.option("header", True).csv(f"{path}/b")
    raw = D.read_wide_ballots(spark, [f"{path}/a", f"{path}/b"], multi_line=False).withColumn("county_name", F.lit("ONE"))
    return D.number_rows(raw, "idx", ["county_name"]).agg(
        F.sum(F.col("Gov Ann").cast("bigint")).alias("ann"), F.sum(F.col("Gov Bob").cast("bigint")).alias("bob"),
        F.count(F.lit(1)).alias("n"), F.count_distinct("idx").alias("n_ids"), F.max(F.col("Line").cast("bigint")).alias("most"),
    )


@query(
    "repeated_header_county",
    """SELECT CASE WHEN c_acctbal > 0 THEN 'FIRST PERSON' ELSE 'SECOND PERSON' END AS candidate, count(*) AS n,
  CAST(sum(place) AS BIGINT) AS places FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) AS place FROM customer) c GROUP BY 1""",
)
def repeated_header_county(spark: SparkSession, folder: str) -> DataFrame:
    """A county file whose header block stands again mid-file, all the way to ballots numbered without the block."""
    path = scratch_path(spark, "repeated")
    first = F.col("c_acctbal") > 0
    lines = table(spark, folder, "customer").select(
        (F.col("c_custkey") * 10).alias("at"),
        F.concat_ws(",", F.col("c_custkey").cast("string"), F.when(first, "1").otherwise("0"), F.when(first, "0").otherwise("1")).alias("value"),
    )
    block = ("2020 General,,", "Cvr Number,President,President", ",First Person,Second Person", ",DEM,REP")
    heads = [(start + k, v) for start in (-9, 501) for k, v in enumerate(block)]
    file = lines.unionByName(spark.createDataFrame(heads, "at bigint, value string"))
    # the case is one file; a table this long is written by one task
    file.coalesce(1).sortWithinPartitions("at").select("value").write.text(path)
    raw = D.read_multi_header(spark, path, probe=2)
    names = [("President First Person Dem", "First Person"), ("President Second Person Rep", "Second Person")]
    contests = [("OHIO", "WAYNE", c, "PRESIDENT", "1", n, None, "1") for c, n in names]
    long = K.clean_wide(raw, "OHIO", "WAYNE", spark.createDataFrame(contests, _CONTEST_SCHEMA))
    return long.groupBy("candidate").agg(F.count(F.lit(1)).alias("n"), F.sum("cvr_id").alias("places"))


_BUILT = " UNION ALL ".join(
    f"""SELECT '{state}' AS state, '{county}' AS county_name, CASE WHEN {first} THEN 'ANN' ELSE 'BOB' END AS candidate,
  count(*) AS n, count(*) AS n_voters FROM {source} GROUP BY 3"""
    for state, county, first, source in (
        ("OHIO", "WAYNE", "c_acctbal > 0", "customer"), ("OHIO", "GREENE", "c_acctbal > 0", "customer"),
        ("NEW JERSEY", "CUMBERLAND", "c_acctbal > 0", "customer"), ("TEXAS", "WARD", "s_suppkey % 2 = 0", "supplier"),
    )
)


@query("manifest_build", _BUILT + " UNION ALL SELECT 'OHIO', 'LOST', 'SET ASIDE', 0, 0 UNION ALL SELECT 'UTAH', 'SAN JUAN', 'SET ASIDE', 0, 0")
def manifest_build(spark: SparkSession, folder: str) -> DataFrame:
    """A manifest of county files of several kinds, two of them faulty, to the partitioned ballot table."""
    path = scratch_path(spark, "build")
    customers, first = table(spark, folder, "customer"), F.col("c_acctbal") > 0
    yes, no = F.when(first, "1").otherwise("0"), F.when(first, "0").otherwise("1")
    customers.select(F.col("c_custkey").alias("Cvr Number"), yes.alias("Gov Ann"), no.alias("Gov Bob")).write.option("header", True).csv(f"{path}/wide")
    lines = customers.select((F.col("c_custkey") * 10).alias("at"), F.concat_ws(",", F.col("c_custkey").cast("string"), yes, no).alias("value"))
    block = ("2020 General,,", "Cvr Number,Gov,Gov", ",Ann,Bob", ",DEM,REP")
    heads = spark.createDataFrame([(start + k, v) for start in (-9, 501) for k, v in enumerate(block)], "at bigint, value string")
    lines.unionByName(heads).coalesce(1).sortWithinPartitions("at").select("value").write.text(f"{path}/banner")
    offered = customers.select("c_custkey", F.explode(F.array(F.struct(F.lit("Ann").alias("who"), first.alias("vote")), F.struct(F.lit("Bob").alias("who"), (~first).alias("vote")))).alias("o"))
    flags = offered.select(F.col("c_custkey").alias("CVRNumber"), F.lit("Gov").alias("Contest"), F.col("o.who").alias("Candidate"), F.col("o.vote").alias("IsVote"))
    flags.write.option("header", True).csv(f"{path}/flags")
    name = F.when(F.col("s_suppkey") % 2 == 0, "Ann").otherwise("Bob")
    ballot = F.concat(F.lit("<CastVoteRecord><Contests><Contest><Name>Gov</Name><Options><Option><Name>"), name,
                      F.lit("</Name></Option></Options></Contest></Contests><PrecinctSplit><Name>S</Name></PrecinctSplit></CastVoteRecord>"))
    _one_file_each(_in_batches(table(spark, folder, "supplier").select(F.col("s_suppkey").alias("ballot"), ballot.alias("value"))), f"{path}/xml")
    files = [
        ("wide", "OHIO", "WAYNE", "delim", None), ("banner", "OHIO", "GREENE", "delim", None), ("flags", "NEW JERSEY", "CUMBERLAND", "special", None),
        ("xml", "TEXAS", "WARD", "xml", None), ("gone", "OHIO", "LOST", "delim", None), ("x", "UTAH", "SAN JUAN", "special", None), ("wide", "OHIO", "SKIPPED", "delim", "no"),
    ]
    manifest = spark.createDataFrame([(f"{path}/{f[0]}", *f[1:]) for f in files], "path string, state string, county_name string, type string, build string")
    named = [("Gov Ann", "Ann"), ("Gov Bob", "Bob"), ("Gov Ann Dem", "Ann"), ("Gov Bob Rep", "Bob"), ("Gov", None)]
    rows = [(*county, k, "GOVERNOR", "STATEWIDE", n, None, "1") for county in {f[1:3] for f in files} for k, n in named]
    parties = spark.createDataFrame([], "state string, office string, district string, candidate string, party_detailed string, issue string")
    failed = build_ballots(spark, manifest, spark.createDataFrame(rows, _CONTEST_SCHEMA), parties, f"{path}/out")
    built = Y.read_partitioned(spark, f"{path}/out").groupBy("state", "county_name", "candidate").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("cvr_id").alias("n_voters")
    )
    aside = spark.createDataFrame([(*f[:2], "SET ASIDE", 0, 0) for f in failed], "state string, county_name string, candidate string, n bigint, n_voters bigint")
    return built.unionByName(aside)
