"""Queries on aggregation, group statistics, ranks and identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.catalog.base import query
from tallyline.catalog.roles import ballots, returns_of, table, with_ballots, with_returns
from tallyline.functions import nulls as N
from tallyline.functions.text import join_sorted
from tallyline.operators import groups as G
from tallyline.plans import reports as R
from tallyline.plans import second_team as S2


@query(
    "mode_county_sum",
    with_ballots(
        """SELECT state, county_name, mode, CAST(sum(qty) AS BIGINT) AS votes FROM ballots GROUP BY state, county_name, mode
UNION ALL SELECT state, county_name, 'ALL MODES', CAST(sum(qty) AS BIGINT) FROM ballots GROUP BY state, county_name"""
    ),
)
def mode_county_sum(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(spark, folder).withColumnRenamed("qty", "votes")
    fine, coarse = G.two_level_sum(rows, ["state", "county_name"], "mode", "votes")
    return fine.unionByName(coarse.withColumn("mode", F.lit("ALL MODES")))


@query(
    "count_of_counts",
    """SELECT n, count(*) AS nn FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber) t GROUP BY n""",
)
def count_of_counts(spark: SparkSession, folder: str) -> DataFrame:
    return G.count_of_counts(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "distinct_first",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_extendedprice, l_partkey) AS k
  FROM lineitem) t WHERE k = 1""",
)
def distinct_first(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey")
    return G.first_per_key(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_extendedprice", "l_partkey"])


@query("distinct_rows", "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus").distinct()


@query(
    "distinct_count",
    """SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_orders,
  count(DISTINCT line) + max(CASE WHEN line IS NULL THEN 1 ELSE 0 END) AS n_lines
FROM (SELECT *, nullif(l_linenumber, 7) AS line FROM lineitem) t GROUP BY l_returnflag""",
)
def distinct_count(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").withColumn("line", F.nullif("l_linenumber", F.lit(7)))
    # distinct pairs first: the two counts then run over far fewer rows
    orders = rows.select("l_returnflag", "l_orderkey").distinct().groupBy("l_returnflag").agg(
        F.count("l_orderkey").alias("n_orders")
    )
    lines = rows.groupBy("l_returnflag").agg(G.distinct_exact("line", count_null=True).alias("n_lines"))
    return orders.join(lines, "l_returnflag")


_BLANKED = "src AS (SELECT *, CASE WHEN choice_no = 7 AND qty > 25 THEN NULL ELSE qty END AS q FROM ballots)"


def _blanked(spark: SparkSession, folder: str) -> DataFrame:
    gone = (F.col("choice_no") == 7) & (F.col("qty") > 25)
    return ballots(spark, folder).withColumn("q", F.when(~gone, F.col("qty")))


@query(
    "bool_groups",
    with_ballots(
        """SELECT state, county_name, cvr_id,
  CASE WHEN bool_or(q <= 5) THEN false WHEN bool_or(q IS NULL) THEN NULL ELSE true END AS all_over_5,
  CASE WHEN bool_or(q > 45) THEN true WHEN bool_or(q IS NULL) THEN NULL ELSE false END AS any_over_45,
  bool_and(coalesce(q > 5, false)) AS all_known_over_5, bool_or(coalesce(q > 45, false)) AS any_known_over_45
FROM src GROUP BY state, county_name, cvr_id""",
        _BLANKED,
    ),
)
def bool_groups(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["state", "county_name", "cvr_id"]
    return _blanked(spark, folder).groupBy(*keys).agg(
        N.all3(F.col("q") > 5).alias("all_over_5"),
        N.any3(F.col("q") > 45).alias("any_over_45"),
        N.all_true(F.col("q") > 5).alias("all_known_over_5"),
        N.any_true(F.col("q") > 45).alias("any_known_over_45"),
    )


@query(
    "null_sum",
    with_ballots(
        """SELECT state, county_name, cvr_id, CAST(CASE WHEN count(q) = count(*) THEN sum(q) END AS BIGINT) AS strict_sum,
  CAST(coalesce(sum(q), 0) AS BIGINT) AS known_sum FROM src GROUP BY state, county_name, cvr_id""",
        _BLANKED,
    ),
)
def null_sum(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["state", "county_name", "cvr_id"]
    return _blanked(spark, folder).groupBy(*keys).agg(
        N.strict_sum("q").alias("strict_sum"), N.sum0("q").alias("known_sum")
    )


@query(
    "voter_labels",
    with_ballots(
        """SELECT state, county, cvr_id,
  CASE WHEN bool_or(coalesce(party = 'DEM' AND office = 'US PRESIDENT', false)) THEN 'D'
       WHEN bool_or(coalesce(party = 'REP' AND office = 'US PRESIDENT', false)) THEN 'R'
       WHEN bool_or(coalesce(party = 'LBT' AND office = 'US PRESIDENT', false)) THEN 'LBT' END AS pres,
  CASE WHEN bool_or(party IS NULL) THEN NULL
       WHEN count(*) FILTER (WHERE party = 'DEM') > 0 AND count(*) FILTER (WHERE party = 'REP') = 0 THEN 'DEM'
       WHEN count(*) FILTER (WHERE party = 'DEM') > 0 AND count(*) FILTER (WHERE party = 'REP') > 0 THEN 'SPL'
       WHEN count(*) FILTER (WHERE party = 'DEM') = 0 AND count(*) FILTER (WHERE party = 'REP') > 0 THEN 'REP' END AS pid
FROM (SELECT state, county_name AS county, cvr_id, office, CASE WHEN choice_no = 7 THEN NULL ELSE
  CASE party_detailed WHEN 'DEMOCRAT' THEN 'DEM' WHEN 'REPUBLICAN' THEN 'REP' ELSE 'LBT' END END AS party
  FROM ballots) t GROUP BY state, county, cvr_id"""
    ),
)
def voter_labels(spark: SparkSession, folder: str) -> DataFrame:
    codes = {"DEMOCRAT": "DEM", "REPUBLICAN": "REP", "LIBERTARIAN": "LBT"}
    rows = ballots(spark, folder).select(
        "state", F.col("county_name").alias("county"), "cvr_id", "office",
        F.when(F.col("choice_no") != 7, N.lookup("party_detailed", codes)).alias("party"),
    )
    return S2.voter_labels(rows, president=F.col("office") == "US PRESIDENT")


@query(
    "sorted_concat",
    with_ballots(
        """SELECT state, county_name, string_agg(DISTINCT office, '|' ORDER BY office) AS offices,
  string_agg(DISTINCT mode, ';' ORDER BY mode) AS modes FROM ballots GROUP BY state, county_name"""
    ),
)
def sorted_concat(spark: SparkSession, folder: str) -> DataFrame:
    distinct = ballots(spark, folder).select("state", "county_name", "office", "mode").distinct()
    return distinct.groupBy("state", "county_name").agg(
        join_sorted(F.collect_list("office")).alias("offices"), join_sorted(F.collect_list("mode"), ";").alias("modes")
    )


@query(
    "cond_ratio_rollup",
    with_ballots(
        """SELECT CASE WHEN grouping(state) = 1 THEN 'All states' ELSE state END AS state, CAST(grouping(state) AS INTEGER) AS is_total,
  round(sum(CASE WHEN party_detailed = 'DEMOCRAT' THEN 1 ELSE 0 END) /
        sum(CASE WHEN party_detailed IN ('DEMOCRAT', 'REPUBLICAN') THEN 1 ELSE 0 END), 6) AS dem_prez,
  CAST(sum(CASE WHEN party_detailed IN ('DEMOCRAT', 'REPUBLICAN', 'LIBERTARIAN') THEN 1 ELSE 0 END) AS BIGINT) AS n_voters,
  count(DISTINCT county_name) AS n_counties
FROM ballots WHERE office = 'US PRESIDENT' GROUP BY ROLLUP (state)"""
    ),
)
def cond_ratio_rollup(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(spark, folder).where("office = 'US PRESIDENT'")
    return R.tilt(rows, "All states").withColumn("dem_prez", F.round("dem_prez", 6))


@query(
    "grand_total_last",
    with_ballots(
        """SELECT round(sum(CASE WHEN party_detailed = 'DEMOCRAT' THEN qty ELSE 0 END) /
  sum(CASE WHEN party_detailed <> 'LIBERTARIAN' THEN qty ELSE 0 END), 6) AS dem_prez FROM ballots"""
    ),
)
def grand_total_last(spark: SparkSession, folder: str) -> DataFrame:
    totals = R.tilt(ballots(spark, folder), "All states", "qty")
    return R.grand_total(totals, "dem_prez").select(F.round("dem_prez", 6).alias("dem_prez"))


@query(
    "crosstab_margins",
    """SELECT coalesce(o_orderstatus, 'Sum') AS o_orderstatus, coalesce(o_orderpriority, 'Sum') AS o_orderpriority, count(*) AS n
FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""",
)
def crosstab_margins(spark: SparkSession, folder: str) -> DataFrame:
    return G.crosstab_margins(table(spark, folder, "orders"), "o_orderstatus", "o_orderpriority")


def _summary_sql(source: str, variables: list[str], weight: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{v}' AS \"Variable\", round(sum({v} * {weight}) / sum({weight}), 4) AS \"Total\", round(avg({v}), 4) AS \"Mean\", "
        f"round(median({v}), 4) AS \"Median\", round(stddev_samp({v}), 4) AS \"SD\" FROM {source} WHERE {v} IS NOT NULL"
        for v in variables
    )


def _rounded(summary: DataFrame) -> DataFrame:
    return summary.select("Variable", *[F.round(c, 4).alias(c) for c in ("Total", "Mean", "Median", "SD")])


@query("summary_stats", _summary_sql("part", ["p_size", "p_retailprice"], "p_partkey"))
def summary_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(G.variable_summary(table(spark, folder, "part"), ["p_size", "p_retailprice"], "p_partkey"))


@query(
    "summary_stats_skewed",
    _summary_sql(
        "(SELECT l_quantity, CASE WHEN l_discount > 0.02 THEN 7.5 ELSE l_extendedprice END AS price, l_orderkey + 1 AS w "
        "FROM lineitem) t",
        ["l_quantity", "price"],
        "w",
    ),
)
def summary_stats_skewed(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        "l_quantity",
        F.when(F.col("l_discount") > 0.02, F.lit(7.5)).otherwise(F.col("l_extendedprice")).alias("price"),
        (F.col("l_orderkey") + 1).alias("w"),
    )
    return _rounded(G.variable_summary(rows, ["l_quantity", "price"], "w"))


@query(
    "report_numbers",
    with_ballots(
        """SELECT (SELECT count(*) FROM ballots) AS n_records,
  (SELECT count(*) FROM (SELECT DISTINCT office, district, candidate, party_detailed FROM ballots) t) AS n_candidates,
  count(*) AS n_voters, count(DISTINCT state || '/' || county_name) AS n_counties, count(DISTINCT state) AS n_states
FROM ballots WHERE office = 'US PRESIDENT'"""
    ),
)
def report_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return R.release_numbers(ballots(spark, folder)).drop("n_voters_approx")


_MODES = """src AS (SELECT *, CASE WHEN nk % 3 = 0 AND mode = 'TOTAL' THEN 'EARLY' WHEN nk % 3 = 1 THEN 'TOTAL' ELSE mode END AS m
  FROM ballots)"""
_MODE_KEYS = ["state", "county_name", "precinct", "party_detailed"]


def _modes(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("nk") % 3
    return ballots(spark, folder).withColumn(
        "m", F.when((kind == 0) & (F.col("mode") == "TOTAL"), "EARLY").when(kind == 1, "TOTAL").otherwise(F.col("mode"))
    )


def _mode_sql(keep: str, keys: str = ", ".join(_MODE_KEYS)) -> str:
    return with_ballots(
        f"""SELECT state, county_name, m, count(*) AS n, CAST(sum(qty) AS BIGINT) AS votes FROM (
  SELECT *, bool_or(m = 'TOTAL') OVER w AS any_total, bool_or(m <> 'TOTAL') OVER w AS any_part, count(*) OVER w AS size
  FROM src WINDOW w AS (PARTITION BY {keys})) t WHERE {keep} GROUP BY state, county_name, m""",
        _MODES,
    )


def _mode_query(spark: SparkSession, folder: str, rule: str, keys: list[str]) -> DataFrame:
    kept = G.filter_modes(_modes(spark, folder), keys, rule, mode="m")
    return kept.groupBy("state", "county_name", "m").agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("votes"))


@query("mode_filter_a", _mode_sql("NOT (any_total AND m <> 'TOTAL')"))
def mode_filter_a(spark: SparkSession, folder: str) -> DataFrame:
    return _mode_query(spark, folder, "drop_parts", _MODE_KEYS)


@query("mode_filter_b", _mode_sql("size = 1 OR m <> 'TOTAL'"))
def mode_filter_b(spark: SparkSession, folder: str) -> DataFrame:
    return _mode_query(spark, folder, "keep_parts", _MODE_KEYS)


@query("mode_filter_c", _mode_sql("NOT any_total OR m = 'TOTAL'", "state, county_name"))
def mode_filter_c(spark: SparkSession, folder: str) -> DataFrame:
    return _mode_query(spark, folder, "total_only", ["state", "county_name"])


@query("mode_filter_d", _mode_sql("NOT (any_total AND any_part)"))
def mode_filter_d(spark: SparkSession, folder: str) -> DataFrame:
    return _mode_query(spark, folder, "drop_mixed", _MODE_KEYS)


@query(
    "group_size",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) t WHERE n = 1""",
)
def group_size(spark: SparkSession, folder: str) -> DataFrame:
    kept = G.singletons(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "group_share",
    """SELECT l_returnflag, l_linestatus, n, round(n / sum(n) OVER (PARTITION BY l_returnflag), 6) AS share,
  max(n) OVER (PARTITION BY l_returnflag) AS largest
FROM (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus) t""",
)
def group_share(spark: SparkSession, folder: str) -> DataFrame:
    counted = G.tally(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"])
    stats = G.with_group_stats(counted, ["l_returnflag"], __all=F.sum("n"), largest=F.max("n"))
    return stats.withColumn("share", F.round(F.col("n") / F.col("__all"), 6)).drop("__all")


@query(
    "group_min",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM (
  SELECT *, min(l_extendedprice - 100 * l_quantity) OVER (PARTITION BY l_orderkey) AS least FROM lineitem) t
WHERE l_extendedprice - 100 * l_quantity = least""",
)
def group_min(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return G.keep_group_min(rows, ["l_orderkey"], F.col("l_extendedprice") - 100 * F.col("l_quantity"))


@query(
    "group_min_blank",
    """SELECT l_orderkey, l_linenumber, l_quantity,
  CASE WHEN l_extendedprice <> least AND l_linenumber <> 1 THEN NULL ELSE l_partkey END AS l_partkey FROM (
  SELECT *, min(l_extendedprice) OVER (PARTITION BY l_orderkey) AS least FROM lineitem) t""",
)
def group_min_blank(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_extendedprice")
    blanked = G.null_unless_group_min(rows, ["l_orderkey"], "l_extendedprice", ["l_partkey"], F.col("l_linenumber") == 1)
    return blanked.drop("l_extendedprice")


@query(
    "group_any",
    """SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IN (
  SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49) GROUP BY l_orderkey""",
)
def group_any(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity")
    return G.tally(G.keep_group_any(rows, ["l_orderkey"], F.col("l_quantity") >= 49), ["l_orderkey"])


@query(
    "dense_ids",
    """SELECT count(DISTINCT (o_custkey, o_orderstatus)) AS n_keys, count(DISTINCT (o_custkey, o_orderstatus)) AS n_ids,
  CAST(1 AS BIGINT) AS low, count(DISTINCT (o_custkey, o_orderstatus)) AS high FROM orders""",
)
def dense_ids(spark: SparkSession, folder: str) -> DataFrame:
    ids = G.dense_ids(table(spark, folder, "orders"), ["o_custkey", "o_orderstatus"])
    return ids.agg(
        F.count(F.lit(1)).alias("n_keys"), F.count_distinct("id").alias("n_ids"),
        F.min("id").alias("low"), F.max("id").alias("high"),
    )


@query(
    "dense_group_rows",
    """SELECT o_orderstatus, count(DISTINCT o_custkey) AS n_ids, count(*) AS n FROM orders GROUP BY o_orderstatus""",
)
def dense_group_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_custkey", "o_orderstatus")
    numbered = G.attach_ids(rows, ["o_custkey", "o_orderstatus"])
    folded = G.tally(numbered, ["o_orderstatus", "id"])
    return folded.groupBy("o_orderstatus").agg(F.count("id").alias("n_ids"), F.sum("n").alias("n"))


@query(
    "top_candidates",
    with_ballots(
        """SELECT state, office, party_detailed, candidate, votes, cand_rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY state, office, party_detailed ORDER BY votes DESC, candidate) AS INTEGER) AS cand_rank
  FROM (SELECT state, office, party_detailed, candidate, CAST(sum(qty) AS BIGINT) AS votes FROM ballots
        GROUP BY state, office, party_detailed, candidate) t) u"""
    ),
)
def top_candidates(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["state", "office", "party_detailed"]
    summed = G.sum_by(ballots(spark, folder), [*keys, "candidate"], "qty", "votes")
    return G.rank_in_group(summed, keys, [F.desc("votes"), F.asc("candidate")])


@query(
    "group_truths",
    """SELECT l_orderkey, bool_and(l_quantity > 10) AS all_large, bool_or(l_quantity > 10) AS any_large,
  bool_and(l_discount > 0) AS all_cut, bool_or(l_discount > 0) AS any_cut FROM lineitem GROUP BY l_orderkey""",
)
def group_truths(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_discount")
    return G.group_truth(rows, ["l_orderkey"], large=F.col("l_quantity") > 10, cut=F.col("l_discount") > 0)


@query(
    "party_frequency",
    with_returns("SELECT party_detailed, count(*) AS n, CAST(sum(votes) AS BIGINT) AS votes FROM returns GROUP BY 1"),
)
def party_frequency(spark: SparkSession, folder: str) -> DataFrame:
    official = returns_of(ballots(spark, folder))
    return official.groupBy("party_detailed").agg(F.count(F.lit(1)).alias("n"), F.sum("votes").alias("votes"))
