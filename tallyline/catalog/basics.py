"""Queries on projection, filters, recodes, reshaping, sorting and text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.catalog.base import query
from tallyline.catalog.roles import ballots, returns_of, table, with_ballots, with_returns
from tallyline.functions import nulls as N
from tallyline.functions import text as T
from tallyline.operators import columns as P
from tallyline.operators import groups as G
from tallyline.operators import reshape as S
from tallyline.plans.parties import standard_party
from tallyline.plans.second_team import office_type


@query(
    "typed_filter_select",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, 'LINE' AS source FROM lineitem
WHERE l_returnflag IN ('A', 'N') AND l_quantity IS NOT NULL AND l_shipdate >= TIMESTAMP '1998-01-01'""",
)
def typed_filter_select(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").where(
        N.is_in("l_returnflag", ("A", "N"))
        & F.col("l_quantity").isNotNull()
        & (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp"))
    )
    picked = P.select_matching(rows, "key$", "number", "quantity", "flag").drop("l_partkey", "l_suppkey")
    return P.reorder(P.add_literals(picked, source="LINE"), ["l_orderkey", "l_linenumber"])


@query(
    "rename_drop_optional",
    """SELECT c_name AS name, c_nationkey AS nationkey, 'customer' AS kind, CAST(NULL AS VARCHAR) AS precinct FROM customer
UNION ALL SELECT s_name, s_nationkey, 'supplier', NULL FROM supplier""",
)
def rename_drop_optional(spark: SparkSession, folder: str) -> DataFrame:
    made = None
    for kind in ("customer", "supplier"):
        rows = table(spark, folder, kind)
        named = P.rename_aliases(P.rename_aliases(rows, "name", ("c_name", "s_name")), "nationkey", ("c_nationkey", "s_nationkey"))
        kept = P.drop_known(named, ("c_acctbal", "s_acctbal", "c_mktsegment", "not_there"))
        full = P.add_missing(P.add_literals(kept, kind=kind), ["precinct"])
        part = P.select_optional(full, ("name", "nationkey", "kind", "precinct", "absent"))
        made = part if made is None else made.unionByName(part)
    return made


@query(
    "apply_across",
    "SELECT p_partkey, upper(p_name) AS p_name, upper(p_brand) AS p_brand, upper(p_type) AS p_type FROM part",
)
def apply_across(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").drop("p_size", "p_retailprice")
    return P.apply_across(rows, [c for c, t in rows.dtypes if t == "string"], F.upper)


@query(
    "safe_cast",
    """SELECT p_partkey, TRY_CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS brand_no,
       TRY_CAST(p_name AS INTEGER) AS name_no FROM part""",
)
def safe_cast(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part")
    return rows.select(
        "p_partkey", N.number(T.extract("p_brand", "[0-9]+")).alias("brand_no"), N.number("p_name").alias("name_no")
    )


@query(
    "null_safe_not_in",
    with_ballots(
        """SELECT party, count(*) AS n FROM (
  SELECT CASE WHEN choice_no = 7 THEN NULL ELSE party_detailed END AS party FROM ballots) t
WHERE party IS NULL OR party NOT IN ('DEMOCRAT') GROUP BY party"""
    ),
)
def null_safe_not_in(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(spark, folder).select(F.when(F.col("choice_no") != 7, F.col("party_detailed")).alias("party"))
    return G.tally(rows.where(N.not_in("party", ("DEMOCRAT",))), ["party"])


@query(
    "replace_where",
    with_ballots(
        """SELECT kept, blanked, count(*) AS n FROM (
  SELECT CASE WHEN p = 'P7' AND office = 'GOVERNOR' THEN 'MOVED' ELSE county_name END AS kept,
         CASE WHEN p = 'P7' AND office = 'GOVERNOR' THEN 'MOVED'
              WHEN NOT (p = 'P7' AND office = 'GOVERNOR') THEN county_name END AS blanked
  FROM (SELECT *, CASE WHEN choice_no = 3 THEN NULL ELSE precinct END AS p FROM ballots) b) t GROUP BY kept, blanked"""
    ),
)
def replace_where(spark: SparkSession, folder: str) -> DataFrame:
    rows = ballots(spark, folder).withColumn("p", F.when(F.col("choice_no") != 3, F.col("precinct")))
    hit = (F.col("p") == "P7") & (F.col("office") == "GOVERNOR")
    both = rows.select(
        N.replace_where("county_name", hit, F.lit("MOVED")).alias("kept"),
        N.if_else(hit, F.lit("MOVED"), F.col("county_name")).alias("blanked"),
    )
    return G.tally(both, ["kept", "blanked"])


@query(
    "recode_ladder",
    """SELECT p_partkey,
  CASE p_type WHEN 'SMALL' THEN 'S' WHEN 'LARGE' THEN 'L' ELSE p_type END AS recoded,
  CASE p_type WHEN 'SMALL' THEN 'S' WHEN 'LARGE' THEN 'L' END AS mapped,
  CASE WHEN p_size < 10 THEN 'tiny' WHEN p_size < 30 THEN 'mid' ELSE 'big' END AS ladder,
  CASE WHEN p_name ILIKE '%rep%' THEN 'REPUBLICAN' WHEN p_name ILIKE '%dem%' OR p_name ILIKE '%democrat%' THEN 'DEMOCRAT'
       WHEN regexp_matches(p_name, '(?i)LBT|Libertarian|Lib|LPN') THEN 'LIBERTARIAN'
       WHEN regexp_matches(p_name, '(?i)IND|IAP|IPN') THEN 'INDEPENDENT'
       WHEN regexp_matches(p_name, '(?i)NON|NPN|Nonpartisan') THEN 'NONPARTISAN' ELSE upper(p_name) END AS party
FROM part""",
)
def recode_ladder(spark: SparkSession, folder: str) -> DataFrame:
    short = {"SMALL": "S", "LARGE": "L"}
    size = F.col("p_size")
    return table(spark, folder, "part").select(
        "p_partkey",
        N.recode("p_type", short).alias("recoded"),
        N.recode("p_type", short, keep_unmatched=False).alias("mapped"),
        N.first_match([(size < 10, "tiny"), (size < 30, "mid")], F.lit("big")).alias("ladder"),
        standard_party("p_name").alias("party"),
    )


@query(
    "office_types",
    """SELECT p_partkey, CASE
  WHEN level = 'N' THEN 'federal'
  WHEN level = 'S' AND (np = 0 OR np IS NULL) AND measure = 0 THEN 'state partisan'
  WHEN level = 'L' AND (np = 0 OR np IS NULL) AND measure = 0 THEN 'local partisan'
  WHEN level = 'S' AND np IN (1, 2) AND measure = 0 THEN 'state nonpartisan'
  WHEN level = 'L' AND np IN (1, 2) AND measure = 0 THEN 'local nonpartisan'
  WHEN level = 'S' AND measure = 1 THEN 'state measure'
  WHEN level = 'L' AND measure = 1 THEN 'local measure'
  WHEN retention = 1 THEN 'retention'
  WHEN np IS NULL AND choice IN ('NA', '') AND item IN ('NA', '') THEN 'unclassified' END AS office_type
FROM (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'S' WHEN 2 THEN 'L' ELSE 'L' END AS level,
             CASE p_size % 5 WHEN 4 THEN NULL ELSE p_size % 5 END AS np,
             CASE p_partkey % 3 WHEN 2 THEN NULL ELSE p_partkey % 3 END AS measure,
             p_partkey % 2 AS retention, CASE WHEN p_size > 25 THEN 'NA' ELSE p_name END AS choice, 'NA' AS item
      FROM part) t""",
)
def office_types(spark: SparkSession, folder: str) -> DataFrame:
    size, key = F.col("p_size"), F.col("p_partkey")
    rows = table(spark, folder, "part").select(
        "p_partkey",
        # a blank level stands for a local contest
        N.recode((size % 4).cast("string"), {"0": "N", "1": "S", "2": "L", "3": ""}).alias("level"),
        F.when(size % 5 != 4, size % 5).alias("nonpartisan"),
        F.when(key % 3 != 2, key % 3).alias("measure"),
        (key % 2).alias("retention"),
        F.when(size > 25, "NA").otherwise(F.col("p_name")).alias("choice"),
        F.lit("NA").alias("item"),
    )
    return office_type(rows).select("p_partkey", "office_type")


@query(
    "tolerance_filter",
    with_returns(
        """SELECT b.state, b.county_name, b.office, b.district, b.party_detailed, b.candidate, n_cvr, votes AS n_v
FROM (SELECT state, county_name, office, district, party_detailed, candidate, CAST(sum(qty) AS BIGINT) AS n_cvr
      FROM ballots GROUP BY state, county_name, office, district, party_detailed, candidate) b
JOIN returns USING (state, county_name, office, district, party_detailed, candidate)
WHERE n_cvr BETWEEN votes - 3 AND votes + 3 AND votes > 0"""
    ),
)
def tolerance_filter(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["state", "county_name", "office", "district", "party_detailed", "candidate"]
    rows = ballots(spark, folder)
    both = G.sum_by(rows, keys, "qty", "n_cvr").join(returns_of(rows).select(*keys, F.col("votes").alias("n_v")), keys)
    return both.where(F.col("n_cvr").between(F.col("n_v") - 3, F.col("n_v") + 3) & (F.col("n_v") > 0))


@query(
    "map_lookup",
    """SELECT n_name, CASE r_name WHEN 'AFRICA' THEN 'AF' WHEN 'ASIA' THEN 'AS' WHEN 'EUROPE' THEN 'EU' END AS abb
FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def map_lookup(spark: SparkSession, folder: str) -> DataFrame:
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return places.select("n_name", N.lookup("r_name", {"AFRICA": "AF", "ASIA": "AS", "EUROPE": "EU"}).alias("abb"))


@query(
    "ordered_category",
    """SELECT o_orderpriority, count(*) AS n, min(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2
  WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 4 WHEN '5-LOW' THEN 5 END) AS rank
FROM orders GROUP BY o_orderpriority""",
)
def ordered_category(spark: SparkSession, folder: str) -> DataFrame:
    levels = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    counted = G.tally(table(spark, folder, "orders"), ["o_orderpriority"])
    return counted.withColumn("rank", P.ordered_rank("o_orderpriority", levels)).orderBy("rank")


@query(
    "unpivot_measures",
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, '{m}' AS contest, {m} AS candidate FROM "
        "(SELECT l_orderkey, l_linenumber, l_quantity, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax, "
        f"l_extendedprice FROM lineitem) t WHERE {m} IS NOT NULL"
        for m in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
)
def unpivot_measures(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
    )
    return S.to_long(rows, ["l_orderkey", "l_linenumber"], "contest", "candidate")


@query("explode_tokens", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token FROM part")
def explode_tokens(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select("p_partkey", F.split("p_name", " ").alias("tokens"))
    return S.unnest(rows, "tokens", "token")


@query(
    "json_marks",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
  abs(CAST(json_extract(props, '$.k') AS INTEGER) - 50) AS off FROM events""",
)
def json_marks(spark: SparkSession, folder: str) -> DataFrame:
    parsed = table(spark, folder, "events").select("event_id", F.from_json("props", "k int").alias("p"))
    hoisted = S.hoist(parsed, "p", {"k": ["k"]})
    return hoisted.select("event_id", "k", F.abs(F.col("k") - 50).alias("off"))


@query(
    "transmute",
    "SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'F' THEN 0.5 ELSE 1.0 END * 4 AS DOUBLE) AS weight FROM orders",
)
def transmute(spark: SparkSession, folder: str) -> DataFrame:
    factor = P.scale_factor(F.col("o_orderstatus") == "F", 0.5)
    return table(spark, folder, "orders").select("o_orderkey", (factor * 4).alias("weight"))


@query(
    "drop_matching",
    "SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem WHERE l_linestatus = 'O'",
)
def drop_matching(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").where("l_linestatus = 'O'")
    return P.drop_matching(rows, "price$", "^l_(tax|discount|quantity|shipdate)$", "(part|supp)key")


@query(
    "sort_limit",
    """SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
ORDER BY o_orderpriority ASC NULLS LAST, o_totalprice DESC, o_orderkey LIMIT 100""",
)
def sort_limit(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return rows.orderBy(F.asc_nulls_last("o_orderpriority"), F.desc("o_totalprice"), "o_orderkey").limit(100)


@query(
    "pad_format",
    """SELECT p_partkey, CASE WHEN length(CAST(p_size AS VARCHAR)) < 3 THEN lpad(CAST(p_size AS VARCHAR), 3, '0')
         ELSE CAST(p_size AS VARCHAR) END AS district,
  CASE WHEN length(p_type) < 6 THEN lpad(p_type, 6, '0') ELSE p_type END AS wide,
  CASE WHEN length(CAST(TRY_CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS VARCHAR)) < 3
       THEN lpad(CAST(TRY_CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS VARCHAR), 3, '0')
       ELSE CAST(TRY_CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS VARCHAR) END AS number,
  format('{:,}', p_partkey * 1000) AS shown, p_type || '/' || p_brand AS joined,
  upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS title
FROM part""",
)
def pad_format(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        "p_partkey",
        T.pad_left(F.col("p_size").cast("string"), 3).alias("district"),
        T.pad_left("p_type", 6).alias("wide"),
        T.pad_int(T.extract("p_brand", "[0-9]+"), 3).alias("number"),
        T.comma_number(F.col("p_partkey") * 1000).alias("shown"),
        F.concat("p_type", F.lit("/"), "p_brand").alias("joined"),
        T.title_case("p_type").alias("title"),
    )


@query(
    "text_fixups",
    """SELECT c_custkey, regexp_replace(c_name, '0', 'x') AS first_only, regexp_replace(c_name, '[0-9#]', '', 'g') AS letters,
  nullif(regexp_extract(c_name, '[1-9][0-9]*'), '') AS digits, trim(regexp_replace('  ' || c_mktsegment || '   a ', '\\s+', ' ', 'g')) AS squished,
  regexp_replace(c_mktsegment || ' [2]', ' \\[.*\\]', '') AS unpaged,
  regexp_matches('x | ' || c_mktsegment || ' |y', '(^|\\|)\\s*BUILDING\\s*(\\||$)') AS has_building,
  coalesce(nullif(c_mktsegment, 'MACHINERY'), 'none') AS replaced
FROM customer""",
)
def text_fixups(spark: SparkSession, folder: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return table(spark, folder, "customer").select(
        "c_custkey",
        T.replace_first("c_name", "0", "x").alias("first_only"),
        T.remove_all("c_name", "[0-9#]").alias("letters"),
        T.extract("c_name", "[1-9][0-9]*").alias("digits"),
        T.squish(F.concat(F.lit("  "), segment, F.lit("   a "))).alias("squished"),
        T.strip_bracket_suffix(F.concat(segment, F.lit(" [2]"))).alias("unpaged"),
        T.has_field(F.concat(F.lit("x | "), segment, F.lit(" |y")), "BUILDING").alias("has_building"),
        F.coalesce(T.null_tokens("c_mktsegment", ("MACHINERY",)), F.lit("none")).alias("replaced"),
    )


@query(
    "accents_removed",
    """SELECT doc_id, CAST(length(strip_accents(text)) AS INTEGER) AS n_chars, md5(strip_accents(text)) AS digest FROM documents
WHERE lang IN ('es', 'fr', 'de', 'pt', 'it', 'en')""",
)
def accents_removed(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").where(F.col("lang").isin("es", "fr", "de", "pt", "it", "en"))
    plain = rows.select("doc_id", T.strip_accents("text").alias("plain"))
    return plain.select("doc_id", F.length("plain").alias("n_chars"), F.md5(F.encode("plain", "UTF-8")).alias("digest"))


@query(
    "ascii_only",
    "SELECT doc_id, CAST(length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) AS INTEGER) AS n_ascii FROM documents",
)
def ascii_only(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", F.length(T.drop_non_ascii("text")).alias("n_ascii"))


@query(
    "percent_labels",
    with_ballots(
        """SELECT state, party_detailed, n, round(n / total, 6) AS share,
  CASE WHEN round(100 * n / total) = 0 THEN '<1' ELSE CAST(CAST(round(100 * n / total) AS BIGINT) AS VARCHAR) END AS shown
FROM (SELECT state, party_detailed, count(*) AS n, sum(count(*)) OVER (PARTITION BY state) AS total
      FROM ballots GROUP BY state, party_detailed) t"""
    ),
)
def percent_labels(spark: SparkSession, folder: str) -> DataFrame:
    counted = G.tally(ballots(spark, folder), ["state", "party_detailed"])
    shared = G.with_group_stats(counted, ["state"], total=F.sum("n"))
    share = N.ratio(F.col("n"), F.col("total"))
    return shared.select(
        "state", "party_detailed", "n", F.round(share, 6).alias("share"), T.percent_text(share).alias("shown")
    )
