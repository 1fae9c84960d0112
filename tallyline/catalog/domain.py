"""Queries on the domain plans: cleaning, matching, release, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.catalog.base import ORACLES, query
from tallyline.catalog.roles import ballots, places, returns_of, table, with_ballots, with_returns
from tallyline.functions.nulls import first_match, recode
from tallyline.operators import groups as G
from tallyline.operators.pairing import pair_rows_ranked, pair_split_rows
from tallyline.plans import cleaning as K
from tallyline.plans import crosswalk as X
from tallyline.plans import release as L
from tallyline.plans import reports as R
from tallyline.plans import returns as O
from tallyline.plans import second_team as S2
from tallyline.rules.precincts import BALLOT_LABELS, RETURNS_LABELS
from tallyline.session import scratch_path, written_once
from tallyline.sources import layout as Y

# ---------------------------------------------------------------- cleaning


@query(
    "vote_partition",
    with_ballots(
        """SELECT state, county_name, cvr_id, contest, precinct, magnitude, candidate, party_detailed, 'VALID' AS vote_class
FROM flagged WHERE valid
UNION ALL SELECT DISTINCT state, county_name, cvr_id, contest, precinct, magnitude, 'UNDERVOTE', NULL, 'UNDERVOTE'
FROM flagged WHERE NOT any_valid AND undervotes > 0 AND NOT (amb AND NOT all_amb)
UNION ALL SELECT DISTINCT state, county_name, cvr_id, contest, precinct, magnitude, 'OVERVOTE', NULL, 'OVERVOTE'
FROM flagged WHERE NOT any_valid AND overvotes > 0""",
        """marks AS (SELECT state, county_name, cvr_id, office AS contest, precinct, CAST(choice_no % 2 AS VARCHAR) AS magnitude,
  candidate, party_detailed, qty > 25 AS vote, discount > 0.05 AS amb, CASE WHEN choice_no % 3 = 0 THEN 1 ELSE 0 END AS undervotes,
  CASE WHEN tax > 0.06 THEN 1 ELSE 0 END AS overvotes FROM ballots)""",
        """flagged AS (SELECT *, vote AND NOT amb AS valid,
  bool_or(vote AND NOT amb) OVER (PARTITION BY state, county_name, cvr_id, contest) AS any_valid,
  bool_and(CASE WHEN undervotes > 0 THEN amb END) OVER (PARTITION BY state, county_name, cvr_id, contest) AS all_amb FROM marks)""",
    ),
)
def vote_partition(spark: SparkSession, folder: str) -> DataFrame:
    marks = ballots(spark, folder).select(
        "state", "county_name", "cvr_id", F.col("office").alias("contest"), "precinct",
        (F.col("choice_no") % 2).cast("string").alias("magnitude"), "candidate", "party_detailed",
        (F.col("qty") > 25).alias("isVote"), (F.col("discount") > 0.05).alias("isAmbiguous"),
        F.when(F.col("choice_no") % 3 == 0, 1).otherwise(0).alias("undervotes"),
        F.when(F.col("tax") > 0.06, 1).otherwise(0).alias("overvotes"),
    )
    return K.vote_partition(marks, keys=K.BALLOT_KEYS)


# six contest columns of one county; the last column is no contest
_COLUMNS = (
    ("c1", "US HOUSE", "001", "FIRST"), ("c2", "US HOUSE", "001", "SECOND"), ("c3", "US HOUSE", "001", None),
    ("c4", "STATE HOUSE", "002", "THIRD"), ("c5", "STATE HOUSE", "002", "FOURTH"), ("c6", "GOVERNOR", None, "FIFTH"),
)
_MATRIX = """cells AS (SELECT l_orderkey AS cvr_id, 'c' || CAST(l_linenumber AS VARCHAR) AS contest,
    max(CASE WHEN l_quantity <= 25 THEN '0' WHEN l_quantity <= 35 THEN 'X' WHEN l_quantity <= 40 THEN 'Undervote (1)'
        ELSE '1' END) AS cell FROM lineitem GROUP BY 1, 2),
  lookup AS (SELECT * FROM (VALUES """ + ", ".join(
    "(" + ", ".join("CAST(NULL AS VARCHAR)" if v is None else f"'{v}'" for v in row) + ")" for row in _COLUMNS
) + """) AS t(contest, office, district, named)),
  voted AS (SELECT *, bool_or(NOT (cell IN ('0', 'X') OR cell ILIKE '%undervote%'))
    OVER (PARTITION BY cvr_id, office, district) AS voted FROM cells JOIN lookup USING (contest))"""
_MATRIX_SQL = f"""WITH {_MATRIX}
SELECT cvr_id, contest, office, district, voted, CASE WHEN NOT voted AND cell = 'X' THEN NULL WHEN NOT voted THEN 'undervote'
  WHEN cell = '0' THEN NULL ELSE coalesce(named, cell) END AS candidate FROM voted"""


def _matrix_cells(spark: SparkSession, folder: str) -> DataFrame:
    quantity = F.col("l_quantity")
    cell = first_match([(quantity <= 25, "0"), (quantity <= 35, "X"), (quantity <= 40, "Undervote (1)")], F.lit("1"))
    rows = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("cvr_id"), F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("contest"),
        cell.alias("cell"),
    )
    return rows.groupBy("cvr_id", "contest").agg(F.max("cell").alias("cell"))


def _matrix_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(_COLUMNS), "contest string, office string, district string, candidate string")


@query("undervote_matrix", _MATRIX_SQL)
def undervote_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Wide 0/1 ballots: the undervote rule is an expression over a ballot's own cells."""
    wide = _matrix_cells(spark, folder).groupBy("cvr_id").pivot("contest", [f"c{k}" for k in range(1, 8)]).agg(F.first("cell"))
    return K.unpivot_ballots(wide, _matrix_lookup(spark), ids=["cvr_id"]).drop("__pos")


@query("undervote_long", _MATRIX_SQL)
def undervote_long(spark: SparkSession, folder: str) -> DataFrame:
    """The same rule on rows that arrive long already."""
    lookup = _matrix_lookup(spark).withColumnRenamed("candidate", "named")
    long = _matrix_cells(spark, folder).join(lookup, "contest")
    return K.infer_undervotes(long, "cell", "named", ["cvr_id", "office", "district"]).drop("cell", "named")


_TEXTS = (
    "'DEM ' || p_name", "p_name || ' (REP)'", "'Write-in: ' || p_name", "'Joseph R. Biden / Harris'",
    "'José ' || p_name || ' LIB'", "'undervote'", "'GRN ' || p_name || ', Jr.'", "'N/A'",
    "p_name || ' (Independent)'", "'NPA  ' || p_name", "'Blank overvote'", "'Indira ' || p_name", "'Kanye ' || p_name",
)
_MARKS_SQL = (
    ("CONSTITUTION", "^CPF "), ("GREEN", r"^GRN |\(GRN\)|^MTN "),
    ("LIBERTARIAN", r"^LBT |^LIB | LIB$|^LPN | LPN$|^NMD |\(LIB\)|^LBN "),
    ("DEMOCRAT", r"^DEM | DEM$|\(DEM\)|^DFL | DFL$"), ("REPUBLICAN", r"^REP | REP$|\(REP\)"),
    ("SOCIALIST", "^PGP "), ("NO PARTY AFFILIATION", "^NPA "), ("PROGRESSIVE", "^PRO "), ("INDEPENDENT", "^IND |^IAP "),
    ("GRASSROOTS-LEGALIZE CANNABIS", "^GLC "), ("END THE CORRUPTION", "^NME "), ("WRITEIN", "Write"),
)


def _ladder_sql(c: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({c}, '(?i){p}') THEN '{n}'" for n, p in _MARKS_SQL) + " END"


_NOISE = r"^$|^NA$|^N/A$|\([^)]*\)$|\p{Mn}|\p{P}"
_STRIP = (
    r"^CPF |^GRN |^LBT |^DEM | DEM$|^REP | REP$|^PGP |^NPA |^PRO |^IND |^LIB | LIB$|\(REP\)|\(DEM\)|\(LIB\)|\(GRN\)"
    r"|No image found|^DFL | DFL$|^GLC |^LPN | LPN$|^IAP |^NMD |^NME |^MTN |^LBN "
)


@query(
    "candidate_cleaner",
    f"""WITH raw AS (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'US PRESIDENT' ELSE 'US HOUSE' END AS office,
    CASE p_partkey % 13 {" ".join(f"WHEN {k} THEN {t}" for k, t in enumerate(_TEXTS))} END AS text,
    CASE WHEN p_size > 45 THEN 'Reform' END AS stated FROM part),
  one AS (SELECT *, coalesce(upper(stated), {_ladder_sql("text")}) AS p1,
    upper(strip_accents(regexp_replace(text, '{_NOISE}', '', 'g'))) AS c1 FROM raw),
  two AS (SELECT *, coalesce(upper(p1), {_ladder_sql("c1")}) AS p2, CASE
    WHEN office = 'US PRESIDENT' AND c1 LIKE '%BIDEN%' THEN 'JOSEPH R BIDEN'
    WHEN office = 'US PRESIDENT' AND regexp_matches(c1, 'KANYE|WEST') THEN 'KANYE WEST'
    ELSE regexp_replace(c1, '(?i){_STRIP}', '', 'g') END AS c2 FROM one)
SELECT p_partkey, CASE WHEN office = 'US PRESIDENT' AND c2 = 'JOSEPH R BIDEN' THEN 'DEMOCRAT'
    WHEN regexp_matches(c2, '(?i)undervote|overvote|No image found') THEN NULL ELSE p2 END AS party_detailed,
  CASE WHEN c3 LIKE '%WRITE%' THEN 'WRITEIN' ELSE c3 END AS candidate
FROM (SELECT *, trim(regexp_replace(regexp_replace(c2, '{_NOISE}', '', 'g'), '\\s+', ' ', 'g')) AS c3 FROM two) t""",
)
def candidate_cleaner(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select(
        "p_partkey",
        F.when(F.col("p_size") % 2 == 0, "US PRESIDENT").otherwise("US HOUSE").alias("office"),
        first_match([(F.col("p_partkey") % 13 == k, F.expr(t)) for k, t in enumerate(_TEXTS)]).alias("candidate"),
        F.when(F.col("p_size") > 45, "Reform").alias("party_detailed"),
    )
    return K.clean_text(rows).select("p_partkey", "party_detailed", "candidate")


@query(
    "long_ballot_table",
    with_ballots(
        """SELECT state, county_name, cvr_id, office, district, candidate, min(contest) AS contest,
  min(party_detailed) AS party_detailed, county_name AS jurisdiction_name FROM (
  SELECT state, county_name, cvr_id, office, district, trim(replace(candidate, '#', '')) AS candidate, party_detailed, contest FROM (
    SELECT *, office || ' ' || party_detailed AS contest, row_number() OVER (
      PARTITION BY state, county_name, cvr_id, office, district, candidate ORDER BY office || ' ' || party_detailed) AS k
    FROM ballots WHERE choice_no <> 7) t WHERE k = 1) u
GROUP BY state, county_name, cvr_id, office, district, candidate"""
    ),
)
def long_ballot_table(spark: SparkSession, folder: str) -> DataFrame:
    """First full row per voter, contest and choice, then standard text."""
    rows = ballots(spark, folder).select(
        "state", "county_name", "cvr_id", F.when(F.col("choice_no") != 7, F.col("office")).alias("office"), "district",
        "candidate", "party_detailed", F.concat_ws(" ", "office", "party_detailed").alias("contest"),
    )
    return K.clean(rows)


@query(
    "contest_lookup",
    with_ballots(
        """SELECT DISTINCT state, coalesce(county, '') AS county_name, contest, office, candidate,
  replace(replace(CASE WHEN office IN ('STATE HOUSE', 'STATE SENATE', 'US HOUSE') AND length(d) < 3 THEN lpad(d, 3, '0') ELSE d END,
    'COUNTY_NAME', coalesce(county, '')), 'STATEWIDE', state) AS district
FROM (SELECT state, CASE WHEN nk % 6 = 0 THEN NULL ELSE county_name END AS county, office || ' for ' || district AS contest,
        office, candidate, CASE office WHEN 'GOVERNOR' THEN 'STATEWIDE' WHEN 'US PRESIDENT' THEN 'COUNTY_NAME'
        ELSE CAST(CAST(district AS INTEGER) AS VARCHAR) END AS d FROM ballots) t"""
    ),
)
def contest_lookup(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("district").cast("int").cast("string")
    raw = ballots(spark, folder).select(
        "state",
        F.when(F.col("nk") % 6 != 0, F.col("county_name")).alias("county_name"),
        F.concat_ws(" for ", "office", "district").alias("contest"),
        F.lower("office").alias("office"),
        F.lower("candidate").alias("candidate"),
        F.when(F.col("office") == "GOVERNOR", "statewide")
        .when(F.col("office") == "US PRESIDENT", "county_name")
        .otherwise(number)
        .alias("district"),
    ).distinct()
    return K.contest_lookup(raw)


@query(
    "party_lookup",
    with_ballots(
        """SELECT DISTINCT state, office, candidate, party_detailed, CASE WHEN candidate = 'BRAND#3' THEN 'YES' END AS issue,
  CASE WHEN office IN ('STATE HOUSE', 'STATE SENATE', 'US HOUSE') THEN lpad(d, 3, '0') ELSE d END AS district
FROM (SELECT *, CAST(CAST(district AS INTEGER) AS VARCHAR) AS d FROM ballots WHERE choice_no < 3) t"""
    ),
)
def party_lookup(spark: SparkSession, folder: str) -> DataFrame:
    raw = ballots(spark, folder).select(
        "state", F.lower("office").alias("office"), F.col("district").cast("int").cast("string").alias("district"),
        F.when(F.col("choice_no") < 3, F.lower("candidate")).alias("name"), F.lower("party_detailed").alias("party_detailed"),
        F.when(F.col("candidate") == "BRAND#3", "yes").alias("issue"),
    )
    return K.party_lookup(raw, candidate="name")


# ---------------------------------------------------------------- matching


@query(
    "pair_rows_ranked",
    """SELECT user_id, k, max(CASE WHEN missing THEN idx END) AS idx_incomplete, max(CASE WHEN NOT missing THEN idx END) AS idx_complete
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, missing ORDER BY idx) AS k FROM (
  SELECT CAST(user_id AS VARCHAR) AS user_id, event_id + 1 AS idx, event_type = 'error' AS missing FROM events) s) t GROUP BY user_id, k""",
)
def ranked_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return pair_rows_ranked(_pages(spark, folder), "idx", "user_id", "target")


@query(
    "pair_rows_greedy",
    """WITH RECURSIVE pages AS (SELECT event_id + 1 AS idx, CAST(user_id AS VARCHAR) AS user_id, event_type = 'error' AS missing,
    CASE WHEN event_type <> 'error' THEN event_type END AS target, CASE WHEN event_type = 'error' THEN value END AS value FROM events),
  size AS (SELECT max(idx) AS n FROM pages),
  steps AS (SELECT *, row_number() OVER w AS k, count(*) FILTER (WHERE NOT missing) OVER w AS c FROM pages
    WINDOW w AS (PARTITION BY user_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  whole AS (SELECT user_id, c, idx FROM steps WHERE NOT missing),
  walk(user_id, k, idx, missing, top, origin, used, found) AS (
    SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST(0 AS BIGINT), false, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS BIGINT)
    FROM pages
    UNION ALL
    SELECT user_id, k, idx, missing,
      CASE WHEN missing AND (ahead OR behind) THEN idx WHEN NOT missing AND used = 0 THEN idx ELSE top END,
      CASE WHEN missing AND ahead THEN next WHEN NOT missing AND used = 0 THEN idx ELSE origin END,
      CASE WHEN missing AND ahead THEN used + 1 WHEN NOT missing AND used > 0 THEN used - 1 ELSE used END,
      CASE WHEN missing AND ahead THEN next WHEN missing AND behind THEN origin END
    FROM (SELECT *, next IS NOT NULL AND (NOT behind OR next - idx <= idx - top) AS ahead FROM (
      SELECT s.user_id, s.k, s.idx, s.missing, w.top, w.origin, w.used, f.idx AS next,
        coalesce(s.idx - w.top <= n - s.idx, false) AS behind
      FROM walk w JOIN steps s ON s.user_id = w.user_id AND s.k = w.k + 1 CROSS JOIN size
      LEFT JOIN whole f ON f.user_id = s.user_id AND f.c = s.c + w.used + 1) a) b)
SELECT coalesce(max(idx) FILTER (WHERE missing), max(idx)) AS idx, user_id, max(target) AS target,
  arg_max(value, idx) FILTER (WHERE missing) AS value
FROM (SELECT p.*, coalesce(w.found, CASE WHEN NOT p.missing THEN p.idx END, -p.idx) AS ballot
      FROM pages p JOIN walk w ON w.user_id = p.user_id AND w.idx = p.idx AND w.k > 0) m GROUP BY user_id, ballot""",
)
def greedy_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Exact row-by-row pairing of all events (also checked by brute force in the tests)."""
    return pair_split_rows(_pages(spark, folder), "idx", "user_id", "target")


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        (F.col("event_id") + 1).alias("idx"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("target"),
        F.when(F.col("event_type") == "error", F.col("value")).alias("value"),
    )


@query("pair_rows_invariants", """SELECT count(*) AS n_rows, count(*) FILTER (WHERE event_type <> 'error') AS n_complete,
  CAST(sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS BIGINT) AS n_kept_targets FROM events""")
def pair_rows_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """Every row ends in one ballot; a complete row starts exactly one ballot."""
    pages = _pages(spark, folder)
    merged = pair_split_rows(pages, "idx", "user_id", "target")
    kept = merged.select(F.lit(None).cast("bigint").alias("idx"), F.lit(None).alias("target"), F.col("target").alias("kept"))
    both = pages.select("idx", "target", F.lit(None).cast("string").alias("kept")).unionByName(kept)
    return both.agg(
        F.count("idx").alias("n_rows"), F.count("target").alias("n_complete"), F.count("kept").alias("n_kept_targets")
    )


# labels as two sources print them; a third are namesakes
_PRECINCT_SIDES = """cvr_rows AS (SELECT state, county_name, upper('Ward ' || precinct) AS label, office, district,
    party_detailed AS party, count(*) * (CAST(substr(precinct, 2) AS INTEGER) * CAST(substr(precinct, 2) AS INTEGER) + 1) AS n
    FROM ballots WHERE party_detailed IN ('DEMOCRAT', 'REPUBLICAN') GROUP BY state, county_name, precinct, office, district, party_detailed),
  ret_parts AS (SELECT state, county_name, CASE WHEN mode = 'TOTAL' AND precinct <> 'P7' THEN 'MAIL' ELSE mode END AS mode, office, district, party_detailed AS party, precinct AS p,
    CAST(substr(precinct, 2) AS INTEGER) AS k, count(*) * (CAST(substr(precinct, 2) AS INTEGER) * CAST(substr(precinct, 2) AS INTEGER) + 1)
    + CAST(substr(precinct, 2) AS INTEGER) % 4 AS votes FROM ballots
    WHERE party_detailed IN ('DEMOCRAT', 'REPUBLICAN') GROUP BY 1, 2, 3, 4, 5, 6, 7),
  ret_named AS (SELECT *, CASE WHEN k % 3 = 0 THEN 'Ward ' || p WHEN k % 3 = 1 THEN 'Wrad ' || p || 'a' ELSE 'Precinct ' || p END
    AS label FROM ret_parts),
  ret_sized AS (SELECT *, count(*) OVER (PARTITION BY state, county_name, label, office, district, party) AS size FROM ret_named),
  ret_rows AS (SELECT state, county_name, label, office, district, party, CAST(sum(votes) AS BIGINT) AS v
    FROM ret_sized WHERE size = 1 OR mode <> 'TOTAL' GROUP BY 1, 2, 3, 4, 5, 6),
  pairs AS (SELECT c.state, c.county_name, c.label AS x, r.label AS y, CAST(sum(abs(n - v)) AS BIGINT) AS discrepancy,
    CAST(sum(n) AS BIGINT) AS cvr_votes, CAST(sum(v) AS BIGINT) AS prec_votes,
    string_agg(DISTINCT c.office, '|' ORDER BY c.office) AS offices
    FROM cvr_rows c JOIN ret_rows r ON c.state = r.state AND c.county_name = r.county_name AND c.office = r.office
      AND c.district = r.district AND c.party = r.party GROUP BY 1, 2, 3, 4),
  scored AS (SELECT *, CAST(levenshtein(upper(x), upper(y)) AS INTEGER) AS dist FROM pairs),
  kept AS (SELECT * FROM (SELECT *, min(dist) OVER w AS least_dist, min(discrepancy + dist) OVER w AS least FROM scored
    WINDOW w AS (PARTITION BY state, county_name, x)) t
    WHERE dist = 0 OR (least_dist > 0 AND discrepancy + dist = least)),
  blanked AS (SELECT *, discrepancy <> min(discrepancy) OVER (PARTITION BY state, county_name, y) AND dist <> 0 AS beaten FROM kept)"""


def _sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = ballots(spark, folder)
    by_mail = (F.col("mode") == "TOTAL") & (F.col("precinct") != "P7")
    official = G.tally(
        rows.withColumn("mode", F.when(by_mail, "MAIL").otherwise(F.col("mode"))), ["state", "county_name", "precinct", "mode", "office", "district", "party_detailed"], "votes"
    ).withColumnRenamed("party_detailed", "party_simplified")
    number = F.substring("precinct", 2, 9).cast("int")
    k, size = number % 3, number * number + 1  # precincts of very different size
    printed = first_match(
        [(k == 0, F.concat(F.lit("Ward "), "precinct")), (k == 1, F.concat(F.lit("Wrad "), "precinct", F.lit("a")))],
        F.concat(F.lit("Precinct "), "precinct"),
    )
    counted = X.ballot_votes(rows, F.upper(F.concat(F.lit("Ward "), "precinct")))
    voters = F.regexp_replace("label", "[^0-9]", "").cast("int")
    return (
        counted.withColumn("n", F.col("n") * (voters * voters + 1)),
        X.returns_votes(official.withColumn("votes", F.col("votes") * size + number % 4), printed),
    )


@query(
    "crosswalk_match",
    with_ballots(
        """SELECT state, county_name, x AS label_cvr, CASE WHEN NOT beaten THEN y END AS label_returns,
  CASE WHEN NOT beaten THEN discrepancy END AS discrepancy, cvr_votes, CASE WHEN NOT beaten THEN prec_votes END AS prec_votes,
  offices, CASE WHEN NOT beaten THEN dist END AS name_ed_dist,
  count(*) FILTER (WHERE NOT beaten) OVER (PARTITION BY state, county_name, x) AS times FROM blanked""",
        _PRECINCT_SIDES,
    ),
)
def crosswalk_match(spark: SparkSession, folder: str) -> DataFrame:
    matched = X.match_precincts(*_sides(spark, folder), method="levenshtein")
    return matched.drop("precinct_cvr", "precinct_returns")


@query(
    "crosswalk_printed",
    with_ballots(
        """SELECT state, county_name, x AS label_cvr, substr(x, 6) AS precinct_cvr,
  CASE WHEN NOT beaten THEN regexp_extract(y, 'P[0-9]+') END AS precinct_returns, CASE WHEN NOT beaten THEN y END AS label_returns FROM blanked""",
        _PRECINCT_SIDES,
    ),
)
def crosswalk_printed(spark: SparkSession, folder: str) -> DataFrame:
    """The labels as either source prints them, next to the normalised ones."""
    matched = X.match_precincts(*_sides(spark, folder), method="levenshtein")
    return matched.select("state", "county_name", "label_cvr", "precinct_cvr", "precinct_returns", "label_returns")


# swaps count once; on these labels the oracle's distance agrees with string alignment
@query("crosswalk_match_osa", ORACLES["crosswalk_match"].replace("levenshtein(", "damerau_levenshtein("))
def crosswalk_match_osa(spark: SparkSession, folder: str) -> DataFrame:
    """The same with swaps at cost one (also checked against all pairs in the tests)."""
    return X.match_precincts(*_sides(spark, folder), method="osa").drop("precinct_cvr", "precinct_returns")


_PLACES = (
    ("ARIZONA", "MARICOPA"), ("OREGON", "MARION"), ("OREGON", "YAMHILL"), ("TEXAS", "SMITH"), ("TEXAS", "POTTER"),
    ("OHIO", "BELMONT"), ("OHIO", "WAYNE"), ("MICHIGAN", "CLINTON"), ("NEVADA", "PERSHING"), ("MARYLAND", "HARFORD"),
    ("COLORADO", "BOULDER"), ("NEW JERSEY", "GLOUCESTER"), ("OHIO", "ASHTABULA"), ("VERMONT", "ADDISON"),
)


@query(
    "label_rules",
    f"""WITH src AS (SELECT c_custkey, CASE c_custkey % {len(_PLACES)} {" ".join(f"WHEN {k} THEN '{s}'" for k, (s, _) in enumerate(_PLACES))} END AS state,
    CASE c_custkey % {len(_PLACES)} {" ".join(f"WHEN {k} THEN '{c}'" for k, (_, c) in enumerate(_PLACES))} END AS county_name,
    CASE c_nationkey % 3 WHEN 0 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0') || ' ' || c_mktsegment
      WHEN 1 THEN 'PRECINCT ' || CAST(c_custkey AS VARCHAR) || ' County Only ' ELSE 'CITY OF ' || c_name || ' DISTRICT 4' END AS label
  FROM customer)
SELECT c_custkey, CASE
  WHEN state = 'ARIZONA' THEN nullif(regexp_extract(label, '^\\d{{4}}'), '')
  WHEN state = 'COLORADO' THEN nullif(regexp_extract(label, '^\\d{{10}}'), '')
  WHEN state = 'MARYLAND' THEN regexp_replace(label, '^0', '')
  WHEN state = 'MICHIGAN' THEN nullif(regexp_extract(label, '\\d+'), '')
  WHEN state = 'NEVADA' THEN nullif(regexp_extract(label, 'PRECINCT \\d+'), '')
  WHEN state = 'NEW JERSEY' THEN trim(regexp_replace(regexp_replace(label, '(\\- WARD|DISTRICT).+', ''), '(BOROUGH|CITY|TOWNSHIP) OF ', ''))
  WHEN county_name = 'BELMONT' THEN regexp_replace(label, '^[0-9.,]+', '')
  WHEN county_name = 'WAYNE' THEN nullif(regexp_extract(label, '^[0-9]+'), '')
  WHEN county_name = 'ASHTABULA' THEN regexp_replace(label, '^[0-9.]+? ', '')
  WHEN county_name = 'MARION' THEN nullif(regexp_extract(label, '^\\d+'), '')
  WHEN county_name = 'YAMHILL' THEN regexp_replace(nullif(regexp_extract(label, '^\\d+'), ''), '^0*', '')
  WHEN county_name = 'SMITH' THEN (CASE WHEN length(CAST(TRY_CAST(nullif(regexp_extract(label, '^\\d+'), '') AS INTEGER) AS VARCHAR)) < 3
    THEN lpad(CAST(TRY_CAST(nullif(regexp_extract(label, '^\\d+'), '') AS INTEGER) AS VARCHAR), 3, '0')
    ELSE CAST(TRY_CAST(nullif(regexp_extract(label, '^\\d+'), '') AS INTEGER) AS VARCHAR) END)
  WHEN county_name = 'POTTER' THEN regexp_replace(label, ' County Only\\s*', '')
  ELSE label END AS ballot_label, CASE
  WHEN state = 'ARIZONA' THEN nullif(regexp_extract(label, '^\\d{{4}}'), '')
  WHEN county_name = 'ASHTABULA' THEN regexp_replace(label, '^PRECINCT ', '')
  WHEN county_name IN ('SMITH', 'POTTER') THEN nullif(regexp_extract(label, '\\d{{3}}$'), '')
  ELSE label END AS returns_label FROM src""",
)
def label_rules(spark: SparkSession, folder: str) -> DataFrame:
    key, kind = F.col("c_custkey"), F.col("c_nationkey") % 3
    place = key % len(_PLACES)
    label = first_match(
        [
            (kind == 0, F.concat(F.lpad(key.cast("string"), 5, "0"), F.lit(" "), "c_mktsegment")),
            (kind == 1, F.concat(F.lit("PRECINCT "), key.cast("string"), F.lit(" County Only "))),
        ],
        F.concat(F.lit("CITY OF "), "c_name", F.lit(" DISTRICT 4")),
    )
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        first_match([(place == k, s) for k, (s, _) in enumerate(_PLACES)]).alias("state"),
        first_match([(place == k, c) for k, (_, c) in enumerate(_PLACES)]).alias("county_name"),
        label.alias("label"),
    )
    return rows.select(
        "c_custkey",
        X.label_rules("state", "county_name", "label", BALLOT_LABELS).alias("ballot_label"),
        X.label_rules("state", "county_name", "label", RETURNS_LABELS).alias("returns_label"),
    )


# ---------------------------------------------------------------- returns

_RAW_RETURNS = """raw AS (SELECT CASE state WHEN 'AFRICA' THEN 'GEORGIA' WHEN 'AMERICA' THEN 'ALASKA' WHEN 'ASIA' THEN 'TEXAS' ELSE state END AS state,
    CASE WHEN nk = 12 THEN 'COLLIN' ELSE county_name END AS county_name, 'F' || CAST(nk AS VARCHAR) AS county_fips,
    county_name AS jurisdiction_name, 'J' || CAST(nk AS VARCHAR) AS jurisdiction_fips, precinct, mode, office, district,
    1 AS magnitude, CASE WHEN choice_no = 1 THEN 1 ELSE 0 END AS special, CASE WHEN candidate = 'BRAND#2' THEN 1 ELSE 0 END AS writein,
    CASE candidate WHEN 'BRAND#1' THEN 'UNDERVOTES' WHEN 'BRAND#2' THEN 'WRITEIN' WHEN 'BRAND#4' THEN 'ALLEN BUCKLEY' ELSE candidate END AS candidate,
    CASE WHEN candidate IN ('BRAND#9') THEN NULL WHEN candidate = 'BRAND#5' THEN 'DEMOCRATIC FARMER LABOR' ELSE party_detailed END AS party_detailed,
    party_detailed AS party_simplified, qty AS votes FROM ballots)"""
_STANDARD = """std AS (SELECT state, CASE WHEN state = 'ALASKA' THEN 'STATEWIDE' ELSE county_name END AS county_name, county_fips,
    CASE WHEN state <> 'ALASKA' THEN jurisdiction_name END AS jurisdiction_name, CASE WHEN state <> 'ALASKA' THEN jurisdiction_fips END AS jurisdiction_fips,
    CASE WHEN state = 'TEXAS' AND county_name = 'COLLIN' AND length(precinct) < 7 THEN lpad(precinct, 7, '0') ELSE precinct END AS precinct,
    mode, office, CASE WHEN state = 'GEORGIA' AND special = 1 THEN 'GEORGIA-III' WHEN office IN ('GOVERNOR', 'US SENATE') THEN state
      WHEN office = 'US PRESIDENT' THEN 'FEDERAL' ELSE district END AS district, magnitude, special, writein, candidate,
    CASE WHEN candidate = 'ALLEN BUCKLEY' AND state = 'GEORGIA' THEN 'INDEPENDENT' WHEN candidate = 'UNDERVOTES' THEN 'UNDERVOTE'
      WHEN candidate = 'WRITEIN' THEN 'WRITEIN' WHEN party_detailed = 'DEMOCRATIC FARMER LABOR' THEN 'DEMOCRAT' ELSE party_detailed END AS party_detailed,
    CASE WHEN candidate = 'ALLEN BUCKLEY' AND state = 'GEORGIA' THEN 'OTHER' ELSE party_simplified END AS party_simplified, votes FROM raw),
  single AS (SELECT * FROM (SELECT *, bool_or(mode = 'TOTAL') OVER (PARTITION BY state, county_name, precinct, party_detailed, writein, special) AS any_total
    FROM std) t WHERE NOT (any_total AND mode <> 'TOTAL')),
  filled AS (SELECT s.* EXCLUDE (party_detailed), coalesce(s.party_detailed, CASE WHEN s.state = 'TEXAS' AND s.candidate = 'BRAND#9' THEN 'NO PARTY AFFILIATION' END)
    AS party_detailed FROM single s)"""


def raw_returns(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(spark, folder)
    state = recode("state", {"AFRICA": "GEORGIA", "AMERICA": "ALASKA", "ASIA": "TEXAS"})
    party = (
        F.when(F.col("candidate") == "BRAND#5", "DEMOCRATIC FARMER LABOR")
        .when(F.col("candidate") != "BRAND#9", F.col("party_detailed"))
    )
    return rows.select(
        state.alias("state"),
        F.when(F.col("nk") == 12, "COLLIN").otherwise(F.col("county_name")).alias("county_name"),
        F.concat(F.lit("F"), F.col("nk").cast("string")).alias("county_fips"),
        F.col("county_name").alias("jurisdiction_name"),
        F.concat(F.lit("J"), F.col("nk").cast("string")).alias("jurisdiction_fips"),
        "precinct", "mode", "office", "district", F.lit(1).alias("magnitude"),
        (F.col("choice_no") == 1).alias("special"), (F.col("candidate") == "BRAND#2").alias("writein"),
        recode("candidate", {"BRAND#1": "UNDERVOTES", "BRAND#2": "WRITEIN", "BRAND#4": "ALLEN BUCKLEY"}).alias("candidate"),
        party.alias("party_detailed"), F.col("party_detailed").alias("party_simplified"), F.col("qty").alias("votes"),
    )


def standard_returns(spark: SparkSession, folder: str) -> DataFrame:
    rows = raw_returns(spark, folder)
    named = rows.where("candidate = 'BRAND#9' AND state = 'TEXAS'").select("state", "office", "candidate", "special", "district")
    seat = F.when(F.col("office").isin("GOVERNOR", "US SENATE"), F.col("state")).when(
        F.col("office") == "US PRESIDENT", "FEDERAL"
    ).otherwise(F.col("district"))
    parties = named.select("state", "office", "candidate", seat.alias("district")).distinct()
    return O.standardise(rows, open_parties=parties.withColumn("party_detailed", F.lit("NO PARTY AFFILIATION")))


@query(
    "returns_standard",
    with_ballots(
        """SELECT state, county_name, jurisdiction_name, precinct, mode, office, district, party_detailed, party_simplified, writein, special,
  count(*) AS n, CAST(sum(votes) AS BIGINT) AS votes FROM filled GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11""",
        _RAW_RETURNS,
        _STANDARD,
    ),
)
def returns_standard(spark: SparkSession, folder: str) -> DataFrame:
    keys = [
        "state", "county_name", "jurisdiction_name", "precinct", "mode", "office", "district", "party_detailed",
        "party_simplified", "writein", "special",
    ]
    return standard_returns(spark, folder).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("votes").alias("votes"))


@query(
    "returns_county_totals",
    with_ballots(
        """SELECT state, county_name, county_fips, jurisdiction_name, jurisdiction_fips, office, district, magnitude, special, writein,
  party_detailed, party_simplified, candidate, CAST(sum(votes) AS BIGINT) AS votes FROM filled
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13
UNION ALL SELECT 'FLORIDA', 'BROWARD', '12011', 'BROWARD', '12011', 'STATE HOUSE', '096', 1, 0, 0, 'DEMOCRAT', 'DEMOCRAT',
  'CHRISTINE HUNSCHOFSKY', 66892""",
        _RAW_RETURNS,
        _STANDARD,
    ),
)
def returns_county_totals(spark: SparkSession, folder: str) -> DataFrame:
    return O.county_totals(standard_returns(spark, folder))[1]


# ---------------------------------------------------------------- release

_REAL = """src AS (SELECT *, CASE state WHEN 'AFRICA' THEN 'WISCONSIN' WHEN 'AMERICA' THEN 'ARIZONA' WHEN 'ASIA' THEN 'WEST VIRGINIA'
    WHEN 'EUROPE' THEN 'UTAH' ELSE 'OHIO' END AS st,
    CASE nk WHEN 0 THEN 'BROWN' WHEN 5 THEN 'DANE' WHEN 3 THEN 'SAN JUAN' WHEN 4 THEN 'SENECA' ELSE county_name END AS county,
    CASE candidate WHEN 'BRAND#1' THEN 'WRITE-IN' WHEN 'BRAND#2' THEN 'NO SELECTION' WHEN 'BRAND#3' THEN 'OVERVOTE'
      WHEN 'BRAND#6' THEN 'KANYE WEST' WHEN 'BRAND#7' THEN 'WRITEIN' ELSE candidate END AS cand,
    CASE WHEN candidate IN ('BRAND#6', 'BRAND#8') THEN NULL WHEN candidate = 'BRAND#9' THEN 'W-I'
      WHEN candidate = 'BRAND#10' THEN 'GREEN' ELSE party_detailed END AS party_d,
    CASE WHEN choice_no < 3 THEN NULL WHEN choice_no < 5 THEN -1 ELSE 3 END AS mag,
    CASE precinct WHEN 'P1' THEN 'Village of Pulaski W4, 7' WHEN 'P2' THEN 'Village of Wrightstown W4'
      WHEN 'P3' THEN 'V Brooklyn Wd 2' WHEN 'P4' THEN 'V Cambridge Wd 1' ELSE precinct END AS prec FROM ballots)"""


def team_ballots(spark: SparkSession, folder: str) -> DataFrame:
    """Ballots with the spellings the release rules look for."""
    rows = ballots(spark, folder)
    choice = F.col("choice_no")
    names = {
        "BRAND#1": "WRITE-IN", "BRAND#2": "NO SELECTION", "BRAND#3": "OVERVOTE", "BRAND#6": "KANYE WEST", "BRAND#7": "WRITEIN",
    }
    party = (
        F.when(F.col("candidate") == "BRAND#9", "W-I")
        .when(F.col("candidate") == "BRAND#10", "GREEN")
        .when(~F.col("candidate").isin("BRAND#6", "BRAND#8"), F.col("party_detailed"))
    )
    magnitude = F.when(choice < 3, F.lit(None).cast("int")).when(choice < 5, -1).otherwise(3)
    return rows.select(
        *_team_place(), _team_place()[1].alias("jurisdiction_name"), "cvr_id", "office", "district",
        recode("candidate", names).alias("candidate"), party.alias("party_detailed"), magnitude.alias("magnitude"), "choice_no", "nk",
    )


def _team_place() -> tuple[Column, Column, Column]:
    """State, county and precinct under the names the release rules look for."""
    states = {"AFRICA": "WISCONSIN", "AMERICA": "ARIZONA", "ASIA": "WEST VIRGINIA", "EUROPE": "UTAH", "MIDDLE EAST": "OHIO"}
    counties = first_match(
        [(F.col("nk") == k, c) for k, c in ((0, "BROWN"), (5, "DANE"), (3, "SAN JUAN"), (4, "SENECA"))], F.col("county_name")
    )
    places = {
        "P1": "Village of Pulaski W4, 7", "P2": "Village of Wrightstown W4", "P3": "V Brooklyn Wd 2", "P4": "V Cambridge Wd 1",
    }
    return recode("state", states).alias("state"), counties.alias("county_name"), recode("precinct", places).alias("precinct")


_FORMATTED = """fmt AS (SELECT *, CASE WHEN c2 IN ('UNDERVOTE', 'OVERVOTE', 'NOT QUALIFIED') THEN NULL WHEN p3 = 'WRITEIN' THEN NULL
    WHEN p3 = 'DEMOCRAT' THEN 'DEM' WHEN p3 = 'REPUBLICAN' THEN 'REP' WHEN p3 = 'LIBERTARIAN' THEN 'LBT' WHEN p3 = 'GREEN' THEN 'GRN' ELSE 'OTH' END AS party
  FROM (SELECT *, CASE WHEN c2 = 'WRITEIN' THEN 'WRITEIN' ELSE p2 END AS p3 FROM (
    SELECT *, CASE WHEN cand = 'WRITE-IN' OR party_d = 'W-I' THEN 'WRITEIN' ELSE party_d END AS p2,
      CASE cand WHEN 'WRITE-IN' THEN 'WRITEIN' WHEN 'NO SELECTION' THEN 'UNDERVOTE' ELSE cand END AS c2
    FROM src WHERE NOT (cand = 'KANYE WEST' AND party_d IS NULL AND st = 'UTAH' AND county = 'SAN JUAN')) a) b)"""


@query(
    "release_format",
    with_ballots(
        "SELECT st AS state, county AS county_name, c2 AS candidate, p3 AS party_detailed, party, count(*) AS n FROM fmt GROUP BY 1, 2, 3, 4, 5",
        _REAL,
        _FORMATTED,
    ),
)
def release_format(spark: SparkSession, folder: str) -> DataFrame:
    return G.tally(L.format_release(team_ballots(spark, folder)), ["state", "county_name", "candidate", "party_detailed", "party"])


_MAGNITUDE = """CASE WHEN (mag IS NULL OR mag = -1) AND NOT (st IN ('ARIZONA', 'WEST VIRGINIA') AND office = 'STATE HOUSE') THEN 1
    WHEN (mag IS NULL OR mag = -1) AND st = 'ARIZONA' AND office = 'STATE HOUSE' THEN 2 ELSE mag END"""


@query(
    "magnitude_fill",
    with_ballots(f"SELECT st AS state, office, {_MAGNITUDE} AS magnitude, count(*) AS n FROM src GROUP BY 1, 2, 3", _REAL),
)
def magnitude_fill(spark: SparkSession, folder: str) -> DataFrame:
    return G.tally(L.fill_magnitude(team_ballots(spark, folder)), ["state", "office", "magnitude"])


_MOVED = """CASE WHEN st = 'WISCONSIN' AND county = 'BROWN' AND prec = 'Village of Pulaski W4, 7' THEN 'PULASKI'
    WHEN st = 'WISCONSIN' AND county = 'BROWN' AND prec = 'Village of Wrightstown W4' THEN 'OUTAGAMIE'
    WHEN st = 'WISCONSIN' AND county = 'DANE' AND prec = 'V Brooklyn Wd 2' THEN 'GREEN'
    WHEN st = 'WISCONSIN' AND county = 'DANE' AND prec = 'V Cambridge Wd 1' THEN 'JEFFERSON' ELSE county END"""


@query(
    "reallocate",
    with_ballots(
        f"""SELECT st AS state, {_MOVED} AS county_name, CASE WHEN st = 'WISCONSIN' THEN {_MOVED} ELSE county END AS jurisdiction_name,
  count(*) AS n FROM src GROUP BY 1, 2, 3""",
        _REAL,
    ),
)
def reallocate(spark: SparkSession, folder: str) -> DataFrame:
    moved = L.reallocate_precincts(team_ballots(spark, folder))
    return G.tally(moved, ["state", "county_name", "jurisdiction_name"])


_TEAMS = f"""seneca AS (SELECT st, county, cvr_id, office, district FROM (
    SELECT *, count(*) OVER (PARTITION BY st, county, cvr_id) AS n FROM src WHERE st = 'OHIO' AND county = 'SENECA' AND office = 'STATE HOUSE') t
    WHERE n = 2 AND district = '087'),
  own AS (SELECT * EXCLUDE (county), {_MOVED} AS county FROM src WHERE nk <> 10 AND nk % 4 <> 1),
  meta AS (SELECT DISTINCT st, office, cand, district FROM src WHERE cand = 'BRAND#8'),
  filled AS (SELECT o.* EXCLUDE (party_d), coalesce(o.party_d, CASE WHEN m.cand IS NOT NULL THEN 'REPUBLICAN' END) AS party_d
    FROM own o LEFT JOIN meta m ON o.st = m.st AND o.office = m.office AND o.cand = m.cand AND o.district = m.district),
  src2 AS (SELECT st, county, cvr_id, office, district, cand, party_d, mag, prec FROM filled
    UNION ALL SELECT st, county, cvr_id, office, district, cand, party_d, mag, prec FROM src WHERE nk % 4 = 1 AND choice_no < 6)"""


def teams(spark: SparkSession, folder: str, second: str = "choice_no < 6") -> DataFrame:
    """Both teams' ballots as one; ``second`` says which choices the second team read."""
    rows = team_ballots(spark, folder)
    # places come from the customers, not from their ballots
    homes = places(spark, folder).select(*_team_place(), "nk").distinct()
    counties = homes.select("state", "county_name", "nk").distinct()
    missing = rows.where("candidate = 'BRAND#8'").select("state", "office", "candidate", "district").distinct()
    missing = written_once(missing.withColumn("party_detailed", F.lit("REPUBLICAN")), "missing")
    precincts = homes.select("state", "county_name", "precinct").distinct().select(
        "*", F.col("precinct").alias("precinct_cvr"), F.concat(F.lit("R-"), "precinct").alias("precinct_returns")
    )
    plain = rows.drop("choice_no", "nk")
    return L.coalesce_teams(
        plain,
        rows.where(second).drop("choice_no", "nk"),
        counties.where("nk = 10"),
        counties.where("nk % 4 = 1"),
        missing,
        precincts,
    )


_TEAMS_SQL = f"""SELECT st AS state, county AS county_name, office, c2 AS candidate, p3 AS party_detailed, party,
  {_MAGNITUDE} AS magnitude, CASE WHEN pr.p IS NOT NULL THEN 'R-' || prec END AS precinct_returns, count(*) AS n
FROM fmt LEFT JOIN (SELECT DISTINCT st AS s, county AS c, prec AS p FROM src) pr ON st = s AND county = c AND prec = p
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8"""


@query(
    "coalesce_teams",
    with_ballots(
        _TEAMS_SQL,
        _REAL,
        _TEAMS,
        _FORMATTED.replace("FROM src WHERE", "FROM src2 WHERE"),
    ),
)
def coalesce_teams(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["state", "county_name", "office", "candidate", "party_detailed", "party", "magnitude", "precinct_returns"]
    return G.tally(teams(spark, folder), keys)


@query(
    "coalesce_teams_whole",
    with_ballots(_TEAMS_SQL, _REAL, _TEAMS.replace(" AND choice_no < 6", ""), _FORMATTED.replace("FROM src WHERE", "FROM src2 WHERE")),
)
def coalesce_teams_whole(spark: SparkSession, folder: str) -> DataFrame:
    """As ``coalesce_teams``, with all choices of the second team."""
    keys = ["state", "county_name", "office", "candidate", "party_detailed", "party", "magnitude", "precinct_returns"]
    return G.tally(teams(spark, folder, "true"), keys)


@query(
    "release_subset",
    with_ballots(
        """SELECT state, county_name, coalesce(grp, 'R-' || precinct) AS precinct_returns, coalesce(grp, precinct) AS precinct_cvr, count(*) AS n
FROM ballots LEFT JOIN (SELECT state, county_name, cvr_id, precinct, 'SMALL' AS grp FROM ballots GROUP BY 1, 2, 3, 4 HAVING count(*) = 1) g
  USING (state, county_name, cvr_id, precinct)
WHERE nk % 5 < 2 GROUP BY 1, 2, 3, 4"""
    ),
)
def release_subset(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(spark, folder).select(
        "state", "county_name", "cvr_id", "precinct", "office", "candidate", "nk", F.col("office").alias("contest"),
        F.col("precinct").alias("precinct_cvr"), F.concat(F.lit("R-"), "precinct").alias("precinct_returns"),
    )
    county = rows.select("state", "county_name", (F.col("nk") % 5 < 2).cast("int").alias("release")).distinct()
    lone = G.tally(rows, ["state", "county_name", "cvr_id", "precinct_cvr", "precinct_returns"]).where("n = 1").drop("n")
    groups = lone.withColumns(
        {"precinct_cvr_group": F.lit("SMALL"), "precinct_returns_group": F.lit("SMALL"), "ballot_style": F.lit("s")}
    )
    released = L.subset_release(rows.drop("nk"), county, groups)
    return G.tally(released, ["state", "county_name", "precinct_returns", "precinct_cvr"])


@query(
    "release_checks",
    with_ballots(
        """SELECT 'US SENATE' AS office, n, count(*) AS nn FROM (SELECT state, county_name, cvr_id, CASE WHEN state = 'GEORGIA' THEN district END AS d,
    count(*) AS n FROM ballots WHERE office = 'US SENATE' GROUP BY 1, 2, 3, 4) s GROUP BY n
UNION ALL SELECT 'STATE HOUSE', n, count(*) FROM (SELECT state, county_name, cvr_id, count(*) AS n FROM ballots
    WHERE office = 'STATE HOUSE' AND state NOT IN ('WEST VIRGINIA', 'ARIZONA') GROUP BY 1, 2, 3) h GROUP BY n"""
    ),
)
def release_checks(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(spark, folder)
    senate, house = (
        L.repeated_ballots(rows, office).withColumn("office", F.lit(office)) for office in ("US SENATE", "STATE HOUSE")
    )
    return senate.unionByName(house)


@query(
    "published_release",
    with_ballots(
        """SELECT office, CAST(count(*) AS BIGINT) AS n_observed, CAST(count(*) AS BIGINT) AS n_stored, count(DISTINCT county_name) AS n_counties
FROM (SELECT DISTINCT state, county_name, cvr_id, office FROM ballots) b GROUP BY office"""
    ),
)
def published_release(spark: SparkSession, folder: str) -> DataFrame:
    """Publish a choice per voter and office; the counts the write observed next to those of what it stored."""
    path = scratch_path(spark, "release")
    single = G.first_per_key(ballots(spark, folder), ["state", "county_name", "cvr_id", "office"], ["choice_no"])
    seen = L.publish_release(single, path)
    observed = spark.createDataFrame(list(seen.items()), "office string, n_observed long")
    stored = Y.read_partitioned(spark, path).groupBy("office").agg(
        F.count(F.lit(1)).alias("n_stored"), F.count_distinct("county_name").alias("n_counties")
    )
    return stored.join(observed, "office", "left")


# ---------------------------------------------------------------- second team

_ITEMS = """src AS (SELECT CASE state WHEN 'AFRICA' THEN 'GA' WHEN 'AMERICA' THEN 'AK' WHEN 'ASIA' THEN 'CA' WHEN 'EUROPE' THEN 'DE' ELSE 'XX' END AS state,
    CASE nk WHEN 3 THEN 'Bleckly' ELSE 'San_' || county_name END AS county, cvr_id, precinct, choice_no AS column,
    CASE office WHEN 'US PRESIDENT' THEN 'US_PRES' WHEN 'US SENATE' THEN CASE WHEN choice_no = 1 THEN 'US_SEN (S)' ELSE 'US_SEN' END
      WHEN 'US HOUSE' THEN 'US_REP' WHEN 'STATE SENATE' THEN 'ST_SEN' WHEN 'STATE HOUSE' THEN 'ST_REP' ELSE 'DOG_CATCHER' END AS item,
    CASE WHEN candidate = 'BRAND#1' THEN 'UNDERVOTE' ELSE lower(candidate) END AS choice, CAST(CAST(district AS INTEGER) AS VARCHAR) AS dist,
    CASE party_detailed WHEN 'DEMOCRAT' THEN 'DEM?' WHEN 'REPUBLICAN' THEN 'REP' ELSE CASE WHEN choice_no > 4 THEN 'LIB' ELSE 'XYZ' END END AS party,
    1 AS num_votes FROM ballots)"""


def items(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(spark, folder)
    codes = {
        "US PRESIDENT": "US_PRES", "US SENATE": "US_SEN", "US HOUSE": "US_REP", "STATE SENATE": "ST_SEN",
        "STATE HOUSE": "ST_REP", "GOVERNOR": "DOG_CATCHER",
    }
    special = (F.col("office") == "US SENATE") & (F.col("choice_no") == 1)
    party = (
        F.when(F.col("party_detailed") == "DEMOCRAT", "DEM?")
        .when(F.col("party_detailed") == "REPUBLICAN", "REP")
        .when(F.col("choice_no") > 4, "LIB")
        .otherwise("XYZ")
    )
    return rows.select(
        F.coalesce(recode("state", {"AFRICA": "GA", "AMERICA": "AK", "ASIA": "CA", "EUROPE": "DE"}, False), F.lit("XX")).alias("state"),
        F.when(F.col("nk") == 3, "Bleckly").otherwise(F.concat(F.lit("San_"), "county_name")).alias("county"),
        "cvr_id", "precinct", F.col("choice_no").alias("column"),
        F.when(special, "US_SEN (S)").otherwise(recode("office", codes)).alias("item"),
        F.when(F.col("candidate") == "BRAND#1", "UNDERVOTE").otherwise(F.lower("candidate")).alias("choice"),
        F.col("district").cast("int").cast("string").alias("dist"), party.alias("party"), F.lit(1).alias("num_votes"),
    )


@query(
    "second_team_format",
    with_ballots(
        """SELECT state, county_name, office, district, candidate, party, party_detailed, magnitude, count(*) AS n FROM (
  SELECT st AS state, CASE upper(replace(county, '_', ' ')) WHEN 'BLECKLY' THEN 'BLECKLEY' ELSE upper(replace(county, '_', ' ')) END AS county_name,
    office, upper(choice) AS candidate, party, num_votes AS magnitude,
    CASE WHEN choice = 'UNDERVOTE' THEN 'undervote' WHEN choice <> 'NA' AND party = 'LIB' THEN 'LIBERTARIAN'
      WHEN party = 'DEM?' THEN 'DEMOCRAT' WHEN party = 'REP' THEN 'REPUBLICAN' ELSE party END AS party_detailed,
    CASE WHEN item = 'US_SEN (S)' AND st = 'GEORGIA' THEN 'GEORGIA-III' WHEN office = 'US SENATE' AND st IS NOT NULL THEN st
      WHEN office = 'US HOUSE' AND st IN ('ALASKA', 'DELAWARE') THEN '000' WHEN office = 'US PRESIDENT' THEN 'FEDERAL' ELSE lpad(dist, 3, '0') END AS district
  FROM (SELECT *, CASE state WHEN 'GA' THEN 'GEORGIA' WHEN 'AK' THEN 'ALASKA' WHEN 'CA' THEN 'CALIFORNIA' WHEN 'DE' THEN 'DELAWARE' END AS st,
    CASE item WHEN 'US_PRES' THEN 'US PRESIDENT' WHEN 'US_SEN' THEN 'US SENATE' WHEN 'US_SEN (S)' THEN 'US SENATE' WHEN 'US_REP' THEN 'US HOUSE'
      WHEN 'ST_SEN' THEN 'STATE SENATE' WHEN 'ST_REP' THEN 'STATE HOUSE' END AS office FROM src WHERE item <> 'DOG_CATCHER') a) b
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""",
        _ITEMS,
    ),
)
def second_team_format(spark: SparkSession, folder: str) -> DataFrame:
    common = S2.to_common(S2.keep_items(items(spark, folder)))
    keys = ["state", "county_name", "office", "district", "candidate", "party", "party_detailed", "magnitude"]
    return G.tally(common, keys)


@query(
    "second_team_records",
    with_ballots(
        """SELECT state, county, item, precinct, pres, pid, count(*) AS n FROM single
LEFT JOIN (SELECT DISTINCT state AS s1, county AS c1, cvr_id AS v1, precinct FROM src WHERE cvr_id % 3 > 0) p ON state = s1 AND county = c1 AND cvr_id = v1
LEFT JOIN (SELECT state AS s2, county AS c2, cvr_id AS v2,
    CASE WHEN bool_or(party = 'DEM' AND item = 'US_PRES') THEN 'D' WHEN bool_or(party = 'REP' AND item = 'US_PRES') THEN 'R'
      WHEN bool_or(party = 'LBT' AND item = 'US_PRES') THEN 'LBT' END AS pres,
    CASE WHEN bool_or(party = 'DEM') AND NOT bool_or(party = 'REP') THEN 'DEM' WHEN bool_or(party = 'DEM') AND bool_or(party = 'REP') THEN 'SPL'
      WHEN bool_or(party = 'REP') THEN 'REP' END AS pid FROM single WHERE item LIKE 'US%' GROUP BY 1, 2, 3) l
  ON state = s2 AND county = c2 AND cvr_id = v2
GROUP BY 1, 2, 3, 4, 5, 6""",
        _ITEMS.replace("'DEM?'", "'DEM'").replace("'XYZ'", "'LBT'"),
        """single AS (SELECT state, county, cvr_id, "column", item, party FROM (
  SELECT *, count(*) OVER (PARTITION BY state, county, cvr_id, "column") AS n FROM src) t WHERE n = 1)""",
    ),
)
def second_team_records(spark: SparkSession, folder: str) -> DataFrame:
    rows = items(spark, folder).withColumn("party", recode("party", {"DEM?": "DEM", "XYZ": "LBT"}))
    precincts = rows.where("cvr_id % 3 > 0").select("state", "county", "cvr_id", "precinct").distinct()
    coded = rows.withColumn("choice_id", F.col("party")).drop("precinct")
    meta = coded.select("state", "county", "column", "item", "choice_id", "party").distinct().withColumns(
        {
            "office_type": F.when(F.col("item").startswith("US"), "federal").otherwise("state partisan"),
            **{c: F.lit(None).cast("string") for c in ("dist", "incumbent", "measure", "place", "topic", "unexp_term")},
            "num_votes": F.lit(1),
        }
    )
    records = S2.drop_repeated(coded.drop("party", "dist", "num_votes"))
    labelled = S2.label_records(records, meta, precincts)
    return G.tally(labelled, ["state", "county", "item", "precinct", "pres", "pid"])


# ---------------------------------------------------------------- reports


@query(
    "scaled_coverage",
    with_returns(
        """SELECT state, office, n, total_voters, CASE WHEN f > 0 AND f < 0.005 THEN 0.01 ELSE f END AS frac_covered FROM (
  SELECT r.state, r.office, c.n, r.total_voters, round(c.n / r.total_voters, 6) AS f
  FROM (SELECT state, office, sum(votes) * CASE WHEN office = 'STATE HOUSE' THEN 5e-1 ELSE 1e0 END AS total_voters FROM returns GROUP BY state, office) r
  LEFT JOIN (SELECT state, office, count(*) * CASE WHEN office = 'STATE HOUSE' THEN 5e-1 ELSE 1e0 END AS n
             FROM ballots WHERE state <> 'ASIA' AND candidate <> 'BRAND#1' GROUP BY state, office) c
  ON r.state = c.state AND r.office = c.office) t"""
    ),
)
def scaled_coverage(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(spark, folder)
    release = rows.withColumn("candidate", recode("candidate", {"BRAND#1": "UNDERVOTE"}))
    official = returns_of(rows).withColumnRenamed("party_detailed", "party_simplified")
    covered = R.coverage(release, official, F.col("office") == "STATE HOUSE", ["ASIA"])
    share = F.round("frac_covered", 6)
    return covered.withColumn("frac_covered", share)


@query(
    "county_list",
    with_ballots(
        """SELECT upper(substr(state, 1, 1)) || lower(substr(state, 2)) AS state, county_name, 'Nation_' || substr(county_name, 8) AS county,
  voters_pres, count(*) OVER (PARTITION BY state) AS n_counties, format('{:,}', CAST(sum(voters_pres) OVER (PARTITION BY state) AS BIGINT)) AS n_voters
FROM (SELECT state, county_name, count(*) AS voters_pres FROM ballots WHERE office = 'US PRESIDENT' AND state <> 'MIDDLE EAST' GROUP BY 1, 2) t"""
    ),
)
def county_list(spark: SparkSession, folder: str) -> DataFrame:
    return R.county_list(ballots(spark, folder).where("state <> 'MIDDLE EAST'"))


@query(
    "coverage_map",
    with_ballots(
        """SELECT c.state, t.state_po, t.county_name, modes, county_fips, cvr_votes, prec_votes,
  CASE WHEN cvr_votes IS NOT NULL THEN 'c' WHEN bool_or(cvr_votes IS NOT NULL) OVER (PARTITION BY t.state_po) THEN 'b' ELSE 'a' END AS covered
FROM (SELECT state_po, county_name, lpad(CAST(nk AS VARCHAR), 5, '0') AS county_fips, CAST(sum(qty) AS BIGINT) AS prec_votes,
        string_agg(DISTINCT m, ';' ORDER BY m) AS modes
      FROM (SELECT *, bool_or(m = 'TOTAL') OVER (PARTITION BY state_po, county_name) AS any_total FROM rows) r
      WHERE NOT any_total OR m = 'TOTAL' GROUP BY 1, 2, nk) t
LEFT JOIN (SELECT state, substr(state, 1, 2) AS state_po, county_name, count(*) AS cvr_votes FROM ballots
           WHERE office = 'US PRESIDENT' AND candidate IN ('BRAND#1', 'BRAND#2') AND nk % 3 <> 0 AND state <> 'EUROPE' GROUP BY 1, 2, 3) c
  ON t.state_po = c.state_po AND t.county_name = c.county_name""",
        """rows AS (SELECT substr(state, 1, 2) AS state_po, county_name, nk, qty, CASE WHEN nk % 2 = 0 AND mode = 'TOTAL' THEN 'MAIL' ELSE mode END AS m
  FROM ballots WHERE office = 'US PRESIDENT' AND party_detailed IN ('DEMOCRAT', 'REPUBLICAN'))""",
    ),
)
def coverage_map(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(spark, folder)
    official = rows.select(
        F.substring("state", 1, 2).alias("state_po"), "county_name", F.col("nk").cast("string").alias("county_fips"), "office",
        F.col("party_detailed").alias("party_simplified"), F.col("qty").alias("votes"),
        F.when((F.col("nk") % 2 == 0) & (F.col("mode") == "TOTAL"), "MAIL").otherwise(F.col("mode")).alias("mode"),
    )
    codes = {s: s[:2] for s in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")}
    released = rows.where("nk % 3 <> 0 AND state <> 'EUROPE'")
    return R.county_coverage(released, official, candidates=("BRAND#1", "BRAND#2"), postal=codes)


@query(
    "precinct_check",
    with_ballots(
        """SELECT state, county_name, precinct, party_detailed, n_cvr, n_v,
  CASE party_detailed WHEN 'REPUBLICAN' THEN 'Trump Votes' WHEN 'DEMOCRAT' THEN 'Biden Votes' END AS cand
FROM (SELECT state, county_name, precinct, party_detailed, count(*) AS n_cvr FROM ballots
      WHERE office = 'US PRESIDENT' AND party_detailed IN ('DEMOCRAT', 'REPUBLICAN') AND nk % 5 < 3 GROUP BY 1, 2, 3, 4) b
JOIN (SELECT state, county_name, precinct, party_detailed, CAST(sum(v) AS BIGINT) AS n_v FROM (
        SELECT *, bool_or(mode = 'TOTAL') OVER w AND bool_or(mode <> 'TOTAL') OVER w AS mixed FROM (
          SELECT state, county_name, precinct, party_detailed, mode, CASE WHEN precinct = 'P9' THEN -1 ELSE 1 END AS v FROM ballots
          WHERE office = 'US PRESIDENT' AND party_detailed IN ('DEMOCRAT', 'REPUBLICAN')) r
        WINDOW w AS (PARTITION BY state, county_name, precinct, party_detailed)) t WHERE NOT mixed GROUP BY 1, 2, 3, 4) v
USING (state, county_name, precinct, party_detailed) WHERE n_v > -1"""
    ),
)
def precinct_check(spark: SparkSession, folder: str) -> DataFrame:
    return _precincts(spark, folder)


def _precincts(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(spark, folder)
    counties = rows.where("nk % 5 < 3").select("state", "county_name").distinct()
    official = rows.withColumn("votes", F.when(F.col("precinct") == "P9", -1).otherwise(1))
    return R.precinct_comparison(rows, official, counties, precinct="precinct")


@query(
    "precinct_numbers",
    with_ballots(
        """SELECT count(*) AS n_precincts, count(DISTINCT state || '/' || county_name) AS n_counties,
  count(*) FILTER (WHERE exact) AS n_exact, count(*) FILTER (WHERE near) AS n_within FROM (
  SELECT state, county_name, precinct, bool_or(n_cvr = n_v) AS exact, bool_or(abs(n_cvr - n_v) <= 3) AS near FROM (
    SELECT state, county_name, precinct, party_detailed, count(*) AS n_cvr,
      count(*) + CASE WHEN precinct < 'P2' THEN 0 WHEN precinct < 'P3' THEN 2 ELSE 5 END AS n_v FROM ballots
    WHERE party_detailed <> 'LIBERTARIAN' GROUP BY 1, 2, 3, 4) a GROUP BY 1, 2, 3) b"""
    ),
)
def precinct_numbers(spark: SparkSession, folder: str) -> DataFrame:
    counted = G.tally(
        ballots(spark, folder).where("party_detailed <> 'LIBERTARIAN'"),
        ["state", "county_name", "precinct", "party_detailed"], "n_cvr",
    )
    extra = F.when(F.col("precinct") < "P2", 0).when(F.col("precinct") < "P3", 2).otherwise(5)
    return R.precinct_numbers(counted.withColumn("n_v", F.col("n_cvr") + extra))


@query(
    "state_tilt",
    with_returns(
        """SELECT CASE WHEN state = 'MIDDLE EAST' THEN 'Middle East' ELSE upper(substr(state, 1, 1)) || lower(substr(state, 2)) END AS state,
  is_total, dem_cvr, voters_cvr, dem_pop, voters_pop, round(dem_cvr - dem_pop, 4) AS diff_prez FROM (
  SELECT coalesce(state, 'OUR STATES') AS state, CASE WHEN state IS NULL THEN 1 ELSE 0 END AS is_total,
    round(sum(CASE WHEN party_detailed = 'DEMOCRAT' THEN 1 ELSE 0 END) / sum(CASE WHEN party_detailed <> 'LIBERTARIAN' THEN 1 ELSE 0 END), 5) AS dem_cvr,
    count(*) AS voters_cvr FROM ballots WHERE office = 'US PRESIDENT' AND state <> 'ASIA' GROUP BY ROLLUP (state)
  UNION ALL SELECT 'ALL STATES', NULL, NULL, NULL) c
LEFT JOIN (SELECT coalesce(state, 'OUR STATES') AS state,
    round(sum(CASE WHEN party_detailed = 'DEMOCRAT' THEN votes ELSE 0 END) / sum(CASE WHEN party_detailed <> 'LIBERTARIAN' THEN votes ELSE 0 END), 5) AS dem_pop,
    CAST(sum(votes) AS BIGINT) AS voters_pop FROM returns WHERE office = 'US PRESIDENT' AND state <> 'ASIA' GROUP BY ROLLUP (state)
  UNION ALL SELECT 'ALL STATES', round(sum(CASE WHEN party_detailed = 'DEMOCRAT' THEN votes ELSE 0 END) /
    sum(CASE WHEN party_detailed <> 'LIBERTARIAN' THEN votes ELSE 0 END), 5), CAST(sum(votes) AS BIGINT) FROM returns WHERE office = 'US PRESIDENT') v
USING (state)""".replace("'OUR STATES'", "'Our states'").replace("'ALL STATES'", "'All states'")
    ),
)
def state_tilt(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(spark, folder)
    tilt = R.state_tilt(rows.where("state <> 'ASIA'"), returns_of(rows), "Our states", "All states")
    rounded = tilt.withColumns({c: F.round(c, 5) for c in ("dem_cvr", "dem_pop")})
    named = rounded.withColumn("state", recode("state", {"Our States": "Our states", "All States": "All states"}))
    return named.withColumn("diff_prez", F.round(F.col("dem_cvr") - F.col("dem_pop"), 4)).drop("pct_voters")


@query(
    "census_figures",
    """SELECT c_custkey, round(a / b * 100, 4) AS prop_urb, round(CAST(a + a AS DOUBLE) / b * 100, 4) AS prop_own_occ,
  upper(trim(regexp_extract('  Saint ' || c_mktsegment || ' County, Ohio', '(.*) County', 1))) AS county FROM (
  SELECT c_custkey, c_mktsegment, c_nationkey + 1 AS a, c_custkey % 100 + 1 AS b FROM customer) t""",
)
def census_figures(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer")
    a, b = (F.col("c_nationkey") + 1).cast("double"), (F.col("c_custkey") % 100 + 1).cast("double")
    whole = ("P1_001N", "P2_001N", "P3_001N", "P4_001N", "P12_001N")
    part = ("P2_002N", "H4_002N", "H4_003N", "P3_002N", "P3_003N", "P4_003N", *R.UNDER_18, *R.OVER_65)
    census = rows.select(
        "c_custkey",
        F.concat(F.lit("  Saint "), "c_mktsegment", F.lit(" County, Ohio")).alias("NAME"),
        *[b.alias(c) for c in whole], *[a.alias(c) for c in part],
    )
    figures = R.census_figures(census)
    return figures.select(
        "c_custkey", F.round("prop_urb", 4).alias("prop_urb"), F.round("prop_own_occ", 4).alias("prop_own_occ"), "county"
    )


@query(
    "census_comparison",
    """WITH figures AS (SELECT CAST(c_custkey % 100 + 1 AS DOUBLE) AS tot, (c_custkey % 7 + 1) / (c_custkey % 100 + 1) * 100.0 AS prop_urb,
    CAST(c_nationkey AS DOUBLE) / (c_custkey % 100 + 1) * 100 AS prop_white, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS ours
  FROM customer)
"""
    + " UNION ALL ".join(
        f"""SELECT '{label}' AS "Variable",
  round(sum({v} * tot) FILTER (WHERE ours) / sum(tot) FILTER (WHERE ours), 4) AS "Total_OurData", round(avg({v}) FILTER (WHERE ours), 4) AS "Mean_OurData",
  round(median({v}) FILTER (WHERE ours), 4) AS "Median_OurData", round(stddev_samp({v}) FILTER (WHERE ours), 4) AS "SD_OurData",
  round(sum({v} * tot) / sum(tot), 4) AS "Total_National", round(avg({v}), 4) AS "Mean_National",
  round(median({v}), 4) AS "Median_National", round(stddev_samp({v}), 4) AS "SD_National" FROM figures"""
        for v, label in (("prop_urb", "Percent Urban"), ("prop_white", "Percent White"))
    ),
)
def census_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as counties; those with a finished order are in the release."""
    customers = table(spark, folder, "customer")
    pop = (F.col("c_custkey") % 100 + 1).cast("double")
    urban, white = (F.col("c_custkey") % 7 + 1).cast("double"), F.col("c_nationkey").cast("double")
    cells = {
        "P1_001N": pop, "P2_001N": pop, "P3_001N": pop, "P4_001N": pop, "P12_001N": pop, "P2_002N": urban, "P3_002N": white,
        **{c: F.lit(1.0) for c in ("H4_002N", "H4_003N", "P3_003N", "P4_003N", *R.UNDER_18, *R.OVER_65)},
    }
    name = F.concat(F.col("c_custkey").cast("string"), F.lit(" County, Ohio"))
    key = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    census = R.census_figures(customers.select(key.alias("GEOID"), name.alias("NAME"), *[c.alias(n) for n, c in cells.items()]))
    codes = customers.select(F.lit("OHIO").alias("state"), F.col("c_name").alias("county_name"), key.alias("county_fips"))
    finished = table(spark, folder, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    release = customers.join(finished, "c_custkey", "left_semi").select(F.lit("OHIO").alias("state"), F.col("c_name").alias("county_name"))
    both = R.census_comparison(release, codes, census).where(F.col("Variable").isin("Percent Urban", "Percent White"))
    return both.select("Variable", *[F.round(c, 4).alias(c) for c in both.columns if c != "Variable"])
