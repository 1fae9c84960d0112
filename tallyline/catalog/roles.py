"""The driver's tables in the role of ballots and returns.

A line item is a choice on the ballot of its order: region and nation are state
and county, the part's type the office, its brand the candidate, the return flag
the party.  ``BALLOTS`` and ``RETURNS`` are the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.nulls import lookup
from tallyline.functions.text import pad_left

OFFICE_OF_TYPE = {
    "ECONOMY": "US PRESIDENT", "STANDARD": "US SENATE", "MEDIUM": "US HOUSE",
    "SMALL": "STATE SENATE", "LARGE": "STATE HOUSE", "PROMO": "GOVERNOR",
}
PARTY_OF_FLAG = {"A": "DEMOCRAT", "N": "REPUBLICAN", "R": "LIBERTARIAN"}
MODE_OF_STATUS = {"O": "TOTAL", "F": "EARLY"}


def _case(column: str, mapping: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


BALLOTS = f"""ballots AS (
  SELECT l_orderkey AS cvr_id, r_name AS state, n_name AS county_name, n_nationkey AS nk,
         {_case("p_type", OFFICE_OF_TYPE)} AS office,
         lpad(CAST(p_size % 3 + 1 AS VARCHAR), 3, '0') AS district,
         upper(p_brand) AS candidate, {_case("l_returnflag", PARTY_OF_FLAG)} AS party_detailed,
         {_case("l_linestatus", MODE_OF_STATUS)} AS mode, 'P' || CAST(c_custkey % 50 AS VARCHAR) AS precinct,
         l_linenumber AS choice_no, CAST(l_quantity AS BIGINT) AS qty, l_discount AS discount, l_tax AS tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey)"""

RETURNS = """returns AS (
  SELECT state, county_name, nk, office, district, party_detailed, candidate,
         CAST(sum(qty) + CASE nk % 5
           WHEN 0 THEN 0
           WHEN 1 THEN CASE WHEN district = '001' AND office = 'STATE SENATE' THEN 1 ELSE 0 END
           WHEN 2 THEN (sum(qty) * 3 + 50) // 100
           WHEN 3 THEN 0
           ELSE (sum(qty) * 20 + 50) // 100 END AS BIGINT) AS votes
  FROM ballots GROUP BY state, county_name, nk, office, district, party_detailed, candidate)"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Every (state, county, precinct) a customer lives in."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    place = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    homes = table(spark, folder, "customer").join(place, F.col("c_nationkey") == F.col("n_nationkey"))
    precinct = F.concat(F.lit("P"), (F.col("c_custkey") % 50).cast("string"))
    return homes.select(
        F.col("r_name").alias("state"), F.col("n_name").alias("county_name"), F.col("n_nationkey").alias("nk"), precinct.alias("precinct")
    ).distinct()


def voters(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their county: the small joins come first, before the line items.

    Orders, customers and line items all grow with the data, so their joins are
    merges at any size: size estimates of joined inputs would otherwise have
    the largest table broadcast while it is still small.
    """
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    place = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    customer = table(spark, folder, "customer").join(place, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table(spark, folder, "orders")
    return orders.join(customer.hint("merge"), F.col("o_custkey") == F.col("c_custkey"))


def ballots(spark: SparkSession, folder: str, by_voter: bool = False) -> DataFrame:
    """A row per line item; ``by_voter`` joins the voters last, so that grouping by ``cvr_id`` needs no further exchange."""
    lines = table(spark, folder, "lineitem")
    of_voter = voters(spark, folder).hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
    of_part = table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    choices = lines.join(*of_part).join(*of_voter) if by_voter else lines.join(*of_voter).join(*of_part)
    return choices.select(
        F.col("l_orderkey").alias("cvr_id"),
        F.col("r_name").alias("state"),
        F.col("n_name").alias("county_name"),
        F.col("n_nationkey").alias("nk"),
        lookup("p_type", OFFICE_OF_TYPE).alias("office"),
        pad_left((F.col("p_size") % 3 + 1).cast("string"), 3).alias("district"),
        F.upper("p_brand").alias("candidate"),
        lookup("l_returnflag", PARTY_OF_FLAG).alias("party_detailed"),
        lookup("l_linestatus", MODE_OF_STATUS).alias("mode"),
        F.concat(F.lit("P"), (F.col("c_custkey") % 50).cast("string")).alias("precinct"),
        F.col("l_linenumber").alias("choice_no"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
    )


def off_by_county(votes: Column) -> Column:
    """What the returns add to the ballots, by kind of county."""
    kind = F.col("nk") % 5
    one = (F.col("district") == "001") & (F.col("office") == "STATE SENATE")
    return (
        F.when(kind == 1, F.when(one, 1).otherwise(0))
        .when(kind == 2, F.floor((votes * 3 + 50) / 100))
        .when(kind == 4, F.floor((votes * 20 + 50) / 100))
        .otherwise(0)
    )


def returns_of(rows: DataFrame) -> DataFrame:
    keys = ["state", "county_name", "nk", "office", "district", "party_detailed", "candidate"]
    summed = rows.groupBy(*keys).agg(F.sum("qty").alias("votes"))
    return summed.withColumn("votes", (F.col("votes") + off_by_county(F.col("votes"))).cast("bigint"))


def returns(spark: SparkSession, folder: str) -> DataFrame:
    return returns_of(ballots(spark, folder))


def with_ballots(body: str, *views: str) -> str:
    return "WITH " + ",\n".join([BALLOTS, *views]) + "\n" + body


def with_returns(body: str, *views: str) -> str:
    return "WITH " + ",\n".join([BALLOTS, RETURNS, *views]) + "\n" + body
