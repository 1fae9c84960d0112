"""Queries on tallies against returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.catalog.base import query
from tallyline.catalog.roles import ballots, returns_of, with_returns
from tallyline.operators.groups import width_histogram
from tallyline.plans import compare as C
from tallyline.plans import reports as R
from tallyline.session import written_once

# one source lacks an office in some counties, the other lacks some counties
FIRST = "NOT (nk % 5 = 3 AND office = 'STATE HOUSE')"
SECOND = "nk % 7 <> 4"

_KEYS = "state, county_name, office, district, party_detailed"


def _side(name: str, source: str, where: str, votes: str) -> str:
    total = "CAST(sum(qty) AS BIGINT)" if votes == "qty" else "CAST(sum(votes) AS BIGINT)"
    return f"""{name} AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY {_KEYS} ORDER BY votes DESC, candidate) AS INTEGER) AS cand_rank FROM (
    SELECT {_KEYS}, candidate, {total} AS votes FROM {source} WHERE {where} GROUP BY {_KEYS}, candidate) t)"""


_ON = " AND ".join(
    f"{{a}}.{k} = {{b}}.{k}" for k in ("state", "county_name", "office", "district", "party_detailed", "cand_rank")
)
ALIGNED = (
    _side("h", "ballots", SECOND, "qty"),
    _side("m", "ballots", FIRST, "qty"),
    _side("v", "returns", "votes > 0", "votes"),
    f"""aligned AS (
  SELECT {", ".join(f"coalesce(h.{k}, m.{k}, v.{k}) AS {k}" for k in _KEYS.split(", "))},
         h.candidate AS candidate_h, h.votes AS votes_h, m.candidate AS candidate_m, m.votes AS votes_m,
         CASE WHEN h.state IS NULL AND m.state IS NULL THEN NULL ELSE m.candidate END AS candidate_c,
         CASE WHEN h.state IS NULL AND m.state IS NULL THEN NULL ELSE m.votes END AS votes_c,
         v.candidate AS candidate_v, v.votes AS votes_v
  FROM h FULL JOIN m ON {_ON.format(a="h", b="m")}
  FULL JOIN v ON {" AND ".join(f"coalesce(h.{k}, m.{k}) = v.{k}" for k in (*_KEYS.split(", "), "cand_rank"))})""",
)


def _classes(side: str) -> str:
    return f"""class_{side} AS (
  SELECT state, county_name, CASE
    WHEN bool_and(coalesce(diff = 0, false)) THEN '0 difference'
    WHEN NOT bool_or(miss) AND bool_and(coalesce(share < 0.01, false)) AND bool_or(coalesce(diff <> 0, false))
      THEN 'any < 1% mismatch'
    WHEN NOT bool_or(miss) AND bool_and(coalesce(share < 0.05, false)) AND bool_or(coalesce(share >= 0.01, false))
      THEN 'any < 5% mismatch'
    WHEN NOT bool_or(miss) AND bool_and(coalesce(share < 0.10, false)) AND bool_or(coalesce(share >= 0.05, false))
      THEN 'any < 10% mismatch'
    WHEN NOT bool_or(miss) AND bool_or(coalesce(share > 0.10, false)) THEN 'red'
    WHEN bool_or(miss) AND bool_or(NOT miss) THEN 'candidate missing'
    WHEN bool_and(miss) THEN 'not collected'
    WHEN bool_or(NOT miss AND votes_v IS NULL) THEN 'no entry in returns'
    ELSE 'unclassified' END AS color2_{side}
  FROM (SELECT *, CASE WHEN votes_v <> 0 THEN abs(diff / votes_v) WHEN diff <> 0 THEN 1e308 END AS share FROM (
    SELECT state, county_name, office, party_detailed,
           CASE WHEN count(votes_v) = count(*) THEN CAST(sum(votes_v - coalesce(votes_{side}, 0)) AS DOUBLE) END AS diff,
           CASE WHEN count(votes_v) = count(*) THEN CAST(sum(votes_v) AS DOUBLE) END AS votes_v,
           bool_or(votes_{side} IS NULL) AS miss
    FROM aligned WHERE candidate_{side} IS NOT NULL OR candidate_v IS NOT NULL
    GROUP BY state, county_name, office, party_detailed) p) q
  GROUP BY state, county_name)"""


_SHORT = {
    "US PRESIDENT": "uspres", "US SENATE": "ussen", "US HOUSE": "ushou",
    "STATE SENATE": "stsen", "STATE HOUSE": "sthou", "GOVERNOR": "stgov",
}
_CELLS = ", ".join(
    f"max(CASE WHEN office = '{office}' THEN votes_{s} END) AS {short}_votes_{s}"
    for office, short in _SHORT.items()
    for s in "hmcv"
) + ", " + ", ".join(
    f"max(CASE WHEN office = '{office}' THEN votes_v - votes_{s} END) AS {short}_diff_{s}"
    for office, short in _SHORT.items()
    for s in "hmc"
)


def _rate(side: str) -> str:
    hits = " + ".join(f"CASE WHEN {o}_diff_{side} = 0 THEN 1 ELSE 0 END" for o in _SHORT.values())
    known = " + ".join(f"CASE WHEN {o}_diff_{side} IS NOT NULL THEN 1 ELSE 0 END" for o in _SHORT.values())
    return f"round(({hits}) / ({known}), 6) AS match_score_{side}"


COUNTY = (
    *ALIGNED,
    _classes("h"),
    _classes("m"),
    _classes("c"),
    f"""county AS (
  SELECT w.*, color2_h, color2_m, color2_c, {_rate("h")}, {_rate("m")},
         CAST(coalesce(color2_c IN ('0 difference', 'any < 1% mismatch'), false) AS INT) AS release
  FROM (SELECT state, county_name, {_CELLS} FROM (
      SELECT state, county_name, office,
             {", ".join(f"CAST(coalesce(sum(votes_{s}), 0) AS BIGINT) AS votes_{s}" for s in "hmcv")}
      FROM aligned GROUP BY state, county_name, office) o GROUP BY state, county_name) w
  LEFT JOIN class_h USING (state, county_name) LEFT JOIN class_m USING (state, county_name)
  LEFT JOIN class_c USING (state, county_name))""",
)


def folded(spark: SparkSession, folder: str) -> DataFrame:
    """Ballots folded to one row per candidate: all that tallies and returns need."""
    keys = ["state", "county_name", "nk", "office", "district", "party_detailed", "candidate"]
    return ballots(spark, folder).groupBy(*keys).agg(F.sum("qty").alias("qty"))


def aligned(spark: SparkSession, folder: str) -> DataFrame:
    """Both teams and the returns, aligned by rank; the first team is the release."""
    rows = written_once(folded(spark, folder), "tally")
    first = C.ranked_tally(rows.where(FIRST), weight="qty")
    second = C.ranked_tally(rows.where(SECOND), weight="qty")
    official = returns_of(rows).withColumns({"writein": F.lit(0), "special": F.lit(0)})
    return C.align_candidates(second, first, first, C.returns_tally(official, official))


def county(spark: SparkSession, folder: str) -> DataFrame:
    table = C.county_table(aligned(spark, folder))
    return table.withColumns({f"match_score_{s}": F.round(f"match_score_{s}", 6) for s in "hm"})


@query("compare_release", with_returns("SELECT state, county_name, color2_c, release FROM county", *COUNTY))
def compare_release(spark: SparkSession, folder: str) -> DataFrame:
    flagged = C.classify(aligned(spark, folder), "c").withColumn("release", C.release_flag())
    return flagged.select("state", "county_name", "color2_c", "release")


@query(
    "compare_candidates",
    with_returns(
        f"SELECT {_KEYS}, candidate_h, votes_h, candidate_m, votes_m, candidate_c, votes_c, candidate_v, votes_v FROM aligned",
        *ALIGNED,
    ),
)
def compare_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return aligned(spark, folder).drop("special", "writein")


@query("county_wide", with_returns("SELECT * FROM county", *COUNTY))
def county_wide(spark: SparkSession, folder: str) -> DataFrame:
    return county(spark, folder)


@query(
    "coalesced_comparison",
    with_returns(
        f"""SELECT {_KEYS}, release, candidate_c, votes_c, candidate_v, votes_v,
       round((votes_v - votes_c) / CASE WHEN votes_v <> 0 THEN votes_v END, 6) AS diff_share
FROM aligned JOIN county USING (state, county_name)
WHERE (state, county_name) IN (SELECT (state, county_name) FROM aligned WHERE votes_c IS NOT NULL)""",
        *COUNTY,
    ),
)
def coalesced_comparison(spark: SparkSession, folder: str) -> DataFrame:
    rows = written_once(aligned(spark, folder), "aligned")
    flags = C.classify(rows, "c").withColumn("release", C.release_flag())
    share = F.try_divide(F.col("votes_v") - F.col("votes_c"), F.col("votes_v"))
    return C.coalesced_comparison(rows, flags).drop("diff_pct").withColumn("diff_share", F.round(share, 6))


@query(
    "traffic_light",
    with_returns(
        """SELECT state, county_name, CASE
    WHEN bool_and(p = 0) THEN 'green'
    WHEN bool_and(p = 1 OR p < 0.1) AND count(*) FILTER (WHERE p = 1) < 0.2 * count(*) THEN 'yellow'
    ELSE 'red' END AS color
FROM (SELECT state, county_name, coalesce(CASE
    WHEN votes_c <> 0 THEN abs(votes_v - votes_c) / votes_c WHEN votes_v <> votes_c THEN 1e308 END, 1) AS p
  FROM aligned
  WHERE (state, county_name) IN (SELECT (state, county_name) FROM aligned WHERE votes_c IS NOT NULL)) t
GROUP BY state, county_name""",
        *ALIGNED,
    ),
)
def traffic_light(spark: SparkSession, folder: str) -> DataFrame:
    rows = written_once(aligned(spark, folder), "aligned")
    none = rows.select("state", "county_name").distinct().withColumn("release", F.lit(0))
    return C.traffic_light(C.coalesced_comparison(rows, none))


@query(
    "class_frequency",
    with_returns("SELECT color2_h, color2_m, color2_c, count(*) AS n FROM county GROUP BY 1, 2, 3", *COUNTY),
)
def class_frequency(spark: SparkSession, folder: str) -> DataFrame:
    rows = written_once(aligned(spark, folder), "aligned")
    table = C.classify(rows, "h")
    for side in "mc":
        table = table.join(C.classify(rows, side), ["state", "county_name"], "left")
    return table.groupBy("color2_h", "color2_m", "color2_c").agg(F.count(F.lit(1)).alias("n"))


@query(
    "mismatch_table",
    with_returns(
        """SELECT label AS color2_c, release, count(*) AS n, min(rank) AS rank FROM (
  SELECT release,
    CASE color2_c WHEN '0 difference' THEN '0 discrepancy' WHEN 'any < 1% mismatch' THEN 'any <1% discrepancy'
      WHEN 'any < 5% mismatch' THEN 'any < 5% discrepancy' WHEN 'any < 10% mismatch' THEN 'any < 10% discrepancy'
      WHEN 'red' THEN 'any > 10% discrepancy' WHEN 'no entry in returns' THEN 'candidate missing' ELSE color2_c END AS label,
    CASE color2_c WHEN '0 difference' THEN 1 WHEN 'any < 1% mismatch' THEN 2 WHEN 'any < 5% mismatch' THEN 3
      WHEN 'any < 10% mismatch' THEN 4 WHEN 'red' THEN 5 WHEN 'candidate missing' THEN 6
      WHEN 'no entry in returns' THEN 6 WHEN 'unclassified' THEN 7 END AS rank
  FROM county) t GROUP BY label, release""",
        *COUNTY,
    ),
)
def mismatch_table(spark: SparkSession, folder: str) -> DataFrame:
    flags = C.classify(aligned(spark, folder), "c").withColumn("release", C.release_flag())
    return C.mismatch_table(flags)


@query(
    "match_table",
    with_returns(
        """SELECT coalesce(CAST(a AS VARCHAR), 'Sum') AS match_h, coalesce(CAST(b AS VARCHAR), 'Sum') AS match_m, n
FROM (SELECT a, b, count(*) AS n FROM (
  SELECT CAST(match_score_h = 1 AS INT) AS a, CAST(match_score_m = 1 AS INT) AS b FROM county) f
  WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY CUBE (a, b)) t""",
        *COUNTY,
    ),
)
def match_table(spark: SparkSession, folder: str) -> DataFrame:
    return C.match_table(county(spark, folder))


@query(
    "rank_in_party",
    with_returns(f"SELECT {_KEYS}, candidate, votes, cand_rank FROM v", ALIGNED[2]),
)
def rank_in_party(spark: SparkSession, folder: str) -> DataFrame:
    official = returns_of(ballots(spark, folder))
    return C.ranked_tally(official.where("votes > 0"), weight="votes")


@query(
    "district_differences",
    with_returns(
        """SELECT state, office, county_name, district, release, cvr_votes, total_votes, cvr_votes - total_votes AS diff,
       CASE WHEN total_votes <> 0 AND cvr_votes <> 0
            THEN round((cvr_votes - total_votes) / total_votes, 6) END AS perc_diff
FROM (SELECT state, office, county_name, district, release,
             CAST(coalesce(sum(votes_c), 0) AS BIGINT) AS cvr_votes, CAST(coalesce(sum(votes_v), 0) AS BIGINT) AS total_votes
      FROM aligned JOIN county USING (state, county_name)
      WHERE party_detailed IN ('DEMOCRAT', 'REPUBLICAN')
        AND (state, county_name) IN (SELECT (state, county_name) FROM aligned WHERE votes_c IS NOT NULL)
      GROUP BY state, office, county_name, district, release) t WHERE total_votes >= 150""",
        *COUNTY,
    ),
)
def district_differences(spark: SparkSession, folder: str) -> DataFrame:
    rows = written_once(aligned(spark, folder), "aligned")
    flags = C.classify(rows, "c").withColumn("release", C.release_flag())
    found = R.district_differences(C.coalesced_comparison(rows, flags))
    return found.withColumn("perc_diff", F.round("perc_diff", 6))


@query(
    "histogram",
    with_returns(
        """SELECT release, bin, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM (
  SELECT release, CAST(floor((cvr_votes - total_votes) / total_votes / 0.002) AS BIGINT) AS bin
  FROM (SELECT state, office, county_name, district, release, CAST(coalesce(sum(votes_c), 0) AS DOUBLE) AS cvr_votes,
               CAST(coalesce(sum(votes_v), 0) AS DOUBLE) AS total_votes
        FROM aligned JOIN county USING (state, county_name) WHERE party_detailed IN ('DEMOCRAT', 'REPUBLICAN')
        AND (state, county_name) IN (SELECT (state, county_name) FROM aligned WHERE votes_c IS NOT NULL)
        GROUP BY state, office, county_name, district, release) t
  WHERE total_votes >= 150 AND total_votes <> 0 AND cvr_votes <> 0) u
GROUP BY release, bin""",
        *COUNTY,
    ),
)
def histogram(spark: SparkSession, folder: str) -> DataFrame:
    rows = written_once(aligned(spark, folder), "aligned")
    flags = C.classify(rows, "c").withColumn("release", C.release_flag())
    bins = width_histogram(R.district_differences(C.coalesced_comparison(rows, flags)), "perc_diff", 0.002, ["release"])
    return bins.select("release", "bin", "n", F.round("share", 6).alias("share"))
