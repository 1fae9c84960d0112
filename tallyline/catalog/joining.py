"""Queries on joins, merges, set operations and partitions kept in step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.catalog.base import query
from tallyline.catalog.roles import ballots, returns_of, table, with_ballots, with_returns
from tallyline.operators import groups as G
from tallyline.operators import joins as J
from tallyline.plans import release as L
from tallyline.sources.layout import append_literals, stale_partitions, to_build


@query(
    "left_lookup",
    """SELECT o_orderkey, o_custkey, c_mktsegment FROM orders
LEFT JOIN customer ON o_custkey = CASE WHEN c_custkey % 7 = 0 THEN -c_custkey ELSE c_custkey END""",
)
def left_lookup(spark: SparkSession, folder: str) -> DataFrame:
    unmatched = F.when(F.col("c_custkey") % 7 == 0, -F.col("c_custkey")).otherwise(F.col("c_custkey"))
    customers = table(spark, folder, "customer").select(unmatched.alias("c_custkey"), "c_mktsegment")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return J.join_differing_keys(orders, customers, {"o_custkey": "c_custkey"})


_FIVE = "state, county_name, office, district, candidate"


@query(
    "inner_multi_key",
    with_returns(
        f"""SELECT {_FIVE}, cvr_id, choice_no, qty, total FROM ballots
JOIN (SELECT {_FIVE}, CAST(sum(votes) AS BIGINT) AS total FROM returns GROUP BY {_FIVE}) r USING ({_FIVE})"""
    ),
)
def inner_multi_key(spark: SparkSession, folder: str) -> DataFrame:
    keys = _FIVE.split(", ")
    rows = ballots(spark, folder)
    totals = G.sum_by(returns_of(rows), keys, "votes", "total")
    return rows.select(*keys, "cvr_id", "choice_no", "qty").join(totals, keys, "inner")


@query(
    "full_chain",
    with_ballots(
        """SELECT coalesce(h.state, m.state, v.state) AS state, coalesce(h.party, m.party, v.party) AS party,
  coalesce(h.office, m.office, v.office) AS office, h.n AS n_h, m.n AS n_m,
  CASE WHEN h.state IS NULL AND m.state IS NULL THEN NULL ELSE c.n END AS n_c, v.n AS n_v
FROM (SELECT state, office, party, count(*) AS n FROM src WHERE nk % 2 = 0 AND choice_no < 3 GROUP BY 1, 2, 3) h
FULL JOIN (SELECT state, office, party, count(*) AS n FROM src WHERE nk % 3 = 0 AND office <> 'GOVERNOR' GROUP BY 1, 2, 3) m
  ON h.state = m.state AND h.office = m.office AND h.party IS NOT DISTINCT FROM m.party
LEFT JOIN (SELECT state, office, party, count(*) AS n FROM src WHERE qty > 48 AND nk > 20 GROUP BY 1, 2, 3) c
  ON coalesce(h.state, m.state) = c.state AND coalesce(h.office, m.office) = c.office
  AND (CASE WHEN h.state IS NULL THEN m.party ELSE h.party END) IS NOT DISTINCT FROM c.party
FULL JOIN (SELECT state, office, party, count(*) AS n FROM src WHERE nk % 5 < 4 AND discount > 0.05 GROUP BY 1, 2, 3) v
  ON coalesce(h.state, m.state) = v.state AND coalesce(h.office, m.office) = v.office
  AND (CASE WHEN h.state IS NULL THEN m.party ELSE h.party END) IS NOT DISTINCT FROM v.party""",
        "src AS (SELECT *, CASE WHEN choice_no = 7 THEN NULL ELSE party_detailed END AS party FROM ballots)",
    ),
)
def full_chain(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(spark, folder).withColumn("party", F.when(F.col("choice_no") != 7, F.col("party_detailed")))
    keys = ["state", "office", "party"]
    sides = {
        "h": rows.where("nk % 2 = 0 AND choice_no < 3"),
        "m": rows.where("nk % 3 = 0 AND office <> 'GOVERNOR'"),
        "c": rows.where("qty > 48 AND nk > 20"),
        "v": rows.where("nk % 5 < 4 AND discount > 0.05"),
    }
    stacked = J.stack_sides(keys, **{s: G.tally(r, keys) for s, r in sides.items()})
    first_two = F.col("in_h") | F.col("in_m")
    return stacked.where(first_two | F.col("in_v")).select(
        *keys, "n_h", "n_m", F.when(first_two, F.col("n_c")).alias("n_c"), "n_v"
    )


@query(
    "full_chain_whole",
    with_ballots(
        """SELECT state, office, party, max(n) FILTER (side = 'h') AS n_h, max(n) FILTER (side = 'm') AS n_m, max(n) FILTER (side = 'c') AS n_c,
  max(n) FILTER (side = 'v') AS n_v FROM (
  SELECT 'h' AS side, state, office, party, count(*) AS n FROM src WHERE nk <> 3 GROUP BY ALL
  UNION ALL SELECT 'm', state, office, party, count(*) FROM src WHERE nk <> 5 GROUP BY ALL
  UNION ALL SELECT 'c', state, office, party, count(*) FROM src WHERE nk <> 7 GROUP BY ALL
  UNION ALL SELECT 'v', state, office, party, count(*) FROM src WHERE nk <> 11 GROUP BY ALL) t GROUP BY state, office, party""",
        "src AS (SELECT *, CASE WHEN choice_no = 7 THEN NULL ELSE party_detailed END AS party FROM ballots)",
    ),
)
def full_chain_whole(spark: SparkSession, folder: str) -> DataFrame:
    """As ``full_chain`` over all ballots; each side lacks one nation, so keys are missing on every side."""
    rows = ballots(spark, folder).withColumn("party", F.when(F.col("choice_no") != 7, F.col("party_detailed")))
    keys = ["state", "office", "party"]
    sides = {side: G.tally(rows.where(f"nk <> {nation}"), keys) for side, nation in (("h", 3), ("m", 5), ("c", 7), ("v", 11))}
    return J.stack_sides(keys, **sides).select(*keys, "n_h", "n_m", "n_c", "n_v")


@query(
    "right_join",
    """SELECT n_name, CAST(coalesce(s.n, 0) AS BIGINT) AS n_suppliers FROM
(SELECT s_nationkey, count(*) AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY s_nationkey) s
RIGHT JOIN nation ON s_nationkey = n_nationkey""",
)
def right_join(spark: SparkSession, folder: str) -> DataFrame:
    rich = G.tally(table(spark, folder, "supplier").where("s_acctbal > 5000"), ["s_nationkey"])
    joined = rich.join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "right")
    return joined.select("n_name", F.coalesce("n", F.lit(0)).alias("n_suppliers"))


@query(
    "semi_list",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN
(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def semi_list(spark: SparkSession, folder: str) -> DataFrame:
    listed = table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'")
    kept = J.join_differing_keys(table(spark, folder, "orders"), listed, {"o_custkey": "c_custkey"}, "left_semi")
    return kept.select("o_orderkey", "o_totalprice")


@query(
    "anti_multi",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM lineitem x WHERE x.l_orderkey = l.l_orderkey AND x.l_linenumber = l.l_linenumber AND x.l_quantity > 40)
  AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l.l_orderkey AND o_orderstatus = 'P')
GROUP BY l_orderkey, l_linenumber""",
)
def anti_multi(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    large = lines.where("l_quantity > 40").select("l_orderkey", "l_linenumber")
    pending = table(spark, folder, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    kept = lines.join(pending, "l_orderkey", "left_anti").join(large, ["l_orderkey", "l_linenumber"], "left_anti")
    return G.tally(kept, ["l_orderkey", "l_linenumber"])


@query(
    "star_lookup",
    """SELECT l_orderkey, l_linenumber, p_brand, s_name, o_orderpriority, n_name FROM lineitem
LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def star_lookup(spark: SparkSession, folder: str) -> DataFrame:
    dimensions = [
        (table(spark, folder, "part").select("p_partkey", "p_brand"), {"l_partkey": "p_partkey"}),
        (table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey"), {"l_suppkey": "s_suppkey"}),
        (table(spark, folder, "orders").select("o_orderkey", "o_orderpriority"), {"l_orderkey": "o_orderkey"}),
        (table(spark, folder, "nation").select("n_nationkey", "n_name"), {"s_nationkey": "n_nationkey"}),
    ]
    fact = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return J.star_lookup(fact, dimensions).select(
        "l_orderkey", "l_linenumber", "p_brand", "s_name", "o_orderpriority", "n_name"
    )


@query(
    "checked_join",
    """SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def checked_join(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").withColumnRenamed("c_custkey", "o_custkey")
    joined = J.checked_join(table(spark, folder, "orders"), customers, ["o_custkey"], "left", "many-to-one")
    return joined.select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query(
    "natural_join",
    """SELECT n_name AS name, regionkey, r_name FROM (SELECT n_name, n_regionkey AS regionkey FROM nation) n
JOIN (SELECT r_regionkey AS regionkey, r_name FROM region) r USING (regionkey)""",
)
def natural_join(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("regionkey"))
    region = table(spark, folder, "region").withColumnRenamed("r_regionkey", "regionkey")
    return J.natural_join(nation, region)


@query(
    "override_totals",
    with_returns(
        """SELECT state, county_name, office, CAST(coalesce(ext, votes) AS BIGINT) AS votes FROM
(SELECT state, county_name, office, sum(votes) AS votes FROM returns GROUP BY 1, 2, 3) own LEFT JOIN
(SELECT state, county_name, office, sum(qty) AS ext FROM ballots WHERE nk % 2 = 0 GROUP BY 1, 2, 3) x
USING (state, county_name, office)"""
    ),
)
def override_totals(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["state", "county_name", "office"]
    rows = ballots(spark, folder)
    own = G.sum_by(returns_of(rows), keys, "votes")
    external = G.sum_by(rows.where("nk % 2 = 0"), keys, "qty", "ext")
    return J.override(own, external, keys, "votes", "ext")


_META = """meta AS (SELECT DISTINCT office, district, candidate,
  CASE WHEN candidate < 'BRAND#15' THEN 'METADATA PARTY' END AS party_detailed,
  CASE WHEN candidate = 'BRAND#7' AND office = 'GOVERNOR' THEN 'DUPLICATE' END AS issue FROM ballots)"""


def _metadata(rows: DataFrame) -> DataFrame:
    named = rows.select("office", "district", "candidate").distinct()
    flagged = (F.col("candidate") == "BRAND#7") & (F.col("office") == "GOVERNOR")
    return named.withColumns(
        {
            "party_detailed": F.when(F.col("candidate") < "BRAND#15", F.lit("METADATA PARTY")),
            "issue": F.when(flagged, F.lit("DUPLICATE")),
        }
    )


@query(
    "fill_party",
    with_ballots(
        """SELECT party, count(*) AS n, CAST(sum(qty) AS BIGINT) AS qty FROM (
  SELECT b.qty, coalesce(CASE WHEN b.choice_no = 7 THEN NULL ELSE b.party_detailed END, m.party_detailed) AS party
  FROM ballots b LEFT JOIN meta m ON b.office = m.office AND b.district = m.district AND b.candidate = m.candidate) t
GROUP BY party""",
        _META,
    ),
)
def fill_party(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(spark, folder)
    blanked = rows.withColumn("party_detailed", F.when(F.col("choice_no") != 7, F.col("party_detailed")))
    filled = J.fill(blanked, _metadata(rows), ["office", "district", "candidate"], "party_detailed")
    return filled.groupBy(F.col("party_detailed").alias("party")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("qty").alias("qty")
    )


@query(
    "metadata_wins",
    with_ballots(
        """SELECT office, party, count(*) AS n FROM (
  SELECT b.office, coalesce(m.party_detailed, b.party_detailed) AS party
  FROM ballots b LEFT JOIN meta m ON b.office = m.office AND b.district = m.district AND b.candidate = m.candidate
  WHERE m.issue IS NULL) t GROUP BY office, party""",
        _META,
    ),
)
def metadata_wins(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(spark, folder)
    merged = J.metadata_wins(rows, _metadata(rows), ["office", "district", "candidate"], "party_detailed")
    return merged.groupBy("office", F.col("party_detailed").alias("party")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "redact_precinct",
    with_ballots(
        """SELECT state, county_name, coalesce(grp, precinct) AS precinct, count(*) AS n FROM ballots
LEFT JOIN (SELECT cvr_id, state, county_name, precinct, 'GROUP ' || substr(precinct, 2, 1) AS grp FROM ballots
           GROUP BY cvr_id, state, county_name, precinct HAVING count(*) = 1) g USING (state, county_name, cvr_id, precinct)
GROUP BY 1, 2, 3"""
    ),
)
def redact_precinct(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["state", "county_name", "cvr_id", "precinct"]
    rows = ballots(spark, folder)
    lone = G.tally(rows, keys).where("n = 1").drop("n")
    groups = lone.withColumn("precinct_group", F.concat(F.lit("GROUP "), F.substring("precinct", 2, 1)))
    return G.tally(J.redact(rows, groups, keys, {"precinct": "precinct_group"}), ["state", "county_name", "precinct"])


@query(
    "remap_ids",
    """SELECT coalesce(merged, o_orderkey) AS o_orderkey, o_custkey, o_orderstatus FROM
(SELECT DISTINCT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 1 THEN o_orderkey - 1 END AS merged
 FROM orders WHERE o_orderkey % 3 <> 0) i
LEFT JOIN (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus FROM orders) o ON k = o_orderkey
WHERE o_orderstatus IS NOT NULL""",
)
def remap_ids(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    key = F.col("o_orderkey")
    info = orders.where(key % 3 != 0).select("o_orderkey", F.when(key % 4 == 1, key - 1).alias("merged"))
    records = orders.select("o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"))
    return J.remap_ids(records, info, "o_orderkey", "merged", ["o_orderstatus"])


@query(
    "coalesce_sources",
    with_ballots(
        """SELECT team, state, county_name, count(*) AS n FROM (
  SELECT 'first' AS team, * FROM ballots WHERE nk % 4 <> 1 AND nk <> 10
  UNION ALL SELECT 'second' AS team, * FROM ballots WHERE nk % 4 = 1) t GROUP BY team, state, county_name"""
    ),
)
def coalesce_sources(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(spark, folder)
    counties = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("r_name").alias("state"), F.col("n_name").alias("county_name"), F.col("n_nationkey").alias("nk"))
    both = L.source_precedence(
        rows.withColumn("team", F.lit("first")),
        rows.withColumn("team", F.lit("second")),
        counties.where("nk % 4 = 1").drop("nk"),
        counties.where("nk = 10").drop("nk"),
    )
    return G.tally(both, ["team", "state", "county_name"])


@query(
    "range_anti_header",
    """SELECT l_orderkey, count(*) AS n FROM (
  SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity,
    l_discount, l_tax, l_returnflag, l_linestatus) AS idx FROM lineitem) t
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 50 = 0
                  AND t.l_orderkey BETWEEN o_orderkey - 1 AND o_orderkey + 2) GROUP BY l_orderkey""",
)
def range_anti_header(spark: SparkSession, folder: str) -> DataFrame:
    marks = table(spark, folder, "orders").where("o_orderstatus = 'P' AND o_orderkey % 50 = 0")
    rows = table(spark, folder, "lineitem").select("l_orderkey")
    kept = J.drop_around(rows, "l_orderkey", marks.select(F.col("o_orderkey").alias("l_orderkey")))
    return G.tally(kept, ["l_orderkey"])


@query(
    "stale_partitions",
    with_ballots(
        """SELECT DISTINCT state, county_name FROM ballots WHERE NOT EXISTS (
  SELECT 1 FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE n_nationkey % 3 <> 0 AND r_name = state AND n_name = county_name)"""
    ),
)
def stale(spark: SparkSession, folder: str) -> DataFrame:
    listed = table(spark, folder, "nation").where("n_nationkey % 3 <> 0").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    manifest = listed.select(F.col("r_name").alias("state"), F.col("n_name").alias("county_name"))
    return stale_partitions(ballots(spark, folder), manifest)


@query(
    "manifest_rows",
    """SELECT c_custkey, coalesce(county_name, 'STATEWIDE') AS county_name, c_mktsegment AS type FROM (
  SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE n_name END AS county_name, c_mktsegment, c_acctbal
  FROM customer JOIN nation ON c_nationkey = n_nationkey) t WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING'""",
)
def manifest_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    manifest = rows.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 5 != 0, F.col("n_name")).alias("county_name"),
        F.col("c_mktsegment").alias("type"),
        F.when(F.col("c_acctbal") < 0, "no").alias("build"),
    )
    return to_build(manifest, "BUILDING")


@query(
    "union_missing",
    """SELECT s_name AS name, CAST(s_acctbal AS DOUBLE) AS balance, CAST(NULL AS VARCHAR) AS segment FROM supplier
UNION ALL SELECT c_name, NULL, c_mktsegment FROM customer UNION ALL SELECT 'ADDED ROW', NULL, 'BUILDING'""",
)
def union_missing(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    customers = table(spark, folder, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    both = suppliers.unionByName(customers, allowMissingColumns=True)
    return append_literals(both, [{"name": "ADDED ROW", "segment": "BUILDING"}])


@query(
    "set_difference",
    "SELECT c_nationkey AS nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 4000",
)
def set_difference(spark: SparkSession, folder: str) -> DataFrame:
    here = table(spark, folder, "customer").select(F.col("c_nationkey").alias("nationkey"))
    there = table(spark, folder, "supplier").where("s_acctbal > 4000").select(F.col("s_nationkey").alias("nationkey"))
    return here.subtract(there)


@query(
    "many_to_many_pairs",
    with_returns(
        """SELECT b.state, b.county_name, b.office, b.district, b.party_detailed, count(*) AS n_pairs,
  CAST(sum(abs(n - votes)) AS BIGINT) AS discrepancy
FROM (SELECT state, county_name, office, district, party_detailed, precinct, CAST(sum(qty) AS BIGINT) AS n
      FROM ballots GROUP BY 1, 2, 3, 4, 5, 6) b
JOIN (SELECT state, county_name, office, district, party_detailed, candidate, votes FROM returns) r
  ON b.state = r.state AND b.county_name = r.county_name AND b.office = r.office AND b.district = r.district
  AND b.party_detailed = r.party_detailed
GROUP BY 1, 2, 3, 4, 5"""
    ),
)
def many_to_many_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes and summed differences over all pairs of a contest, without the pairs."""
    keys = ["state", "county_name", "office", "district", "party_detailed"]
    rows = ballots(spark, folder)
    left = G.sum_by(rows, [*keys, "precinct"], "qty", "x").drop("precinct")
    right = returns_of(rows).select(*keys, F.col("votes").alias("x"))
    return J.pair_differences(left, right, keys, "x")

