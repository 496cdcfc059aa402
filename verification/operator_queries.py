"""Registered queries that run each operator directly on the driver's tables, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omnishelf import functions as fn
from omnishelf import operators as op
from omnishelf.operators import checks
from omnishelf.operators.rollup import joined_ranked_set, joined_set
from omnishelf.plans import marts, quality, reports
from omnishelf.session import configure
from omnishelf.sources import payloads
from omnishelf.sources.readers import read_payload, read_tables
from omnishelf.sources.sinks import clustered, overwrite
from verification.derived import table, working_folder
from verification.model_queries import plain
from verification.oracle_models import sk

QUERIES = {}
ORACLE = {}
RUN_AT = "2024-05-01 09:30:00"
# Documents in one file of landed JSON.
PAYLOAD_ROWS = 500_000


def registered(sql: str | None):
    def add(query):
        def wrapped(spark: SparkSession, sf: str) -> DataFrame:
            configure(spark)
            return plain(query(lambda name: table(spark, sf, name), spark))

        QUERIES[query.__name__] = wrapped
        if sql is not None:
            ORACLE[query.__name__] = sql
        return query

    return add


def values(spark: SparkSession, names: str, *rows: str) -> DataFrame:
    """A literal lookup; Spark knows its exact size."""
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({names})")


# ---- scalars ---------------------------------------------------------------------------------


@registered(
    f"""
    SELECT c_custkey, {sk('c_name', 'c_nationkey', 'segment')} AS customer_id FROM (
        SELECT *, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment
        FROM customer)"""
)
def surrogate_key_customer(t, spark):
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    return t("customer").select(
        "c_custkey", fn.surrogate_key("c_name", "c_nationkey", segment).alias("customer_id")
    )


@registered(
    """
    SELECT event_id, try_cast(json_extract_string(props, '$.k') AS bigint) AS k,
           CASE WHEN event_type <> 'error' THEN event_type END AS kind,
           try_cast(CASE WHEN event_type = 'view' THEN 'x' ELSE '12' END AS bigint) AS odd,
           try_cast(CASE WHEN event_type = 'click' THEN '2024-02-30' ELSE '2024-02-29' END AS date)
               ::varchar AS day
    FROM events"""
)
def stage_safe_cast(t, spark):
    kind = F.when(F.col("event_type") == "error", F.lit(" \t")).otherwise(F.col("event_type"))
    odd = F.when(F.col("event_type") == "view", "x").otherwise(" 12 ")
    day = F.when(F.col("event_type") == "click", "2024-02-30").otherwise("2024-02-29")
    return t("events").select(
        "event_id",
        fn.safe_long(F.get_json_object("props", "$.k")).alias("k"),
        fn.blank_to_null(kind).alias("kind"),
        fn.safe_long(odd).alias("odd"),
        fn.safe_date(day).alias("day"),
    )


@registered(
    """
    SELECT c_custkey, c_name AS code, c_name AS display,
           CASE WHEN c_nationkey < 10 THEN c_nationkey ELSE NULL END AS whole
    FROM customer"""
)
def strip_wrappers(t, spark):
    nation = F.col("c_nationkey").cast("string")
    return t("customer").select(
        "c_custkey",
        fn.strip_sheet_quotes(F.concat(F.lit('="'), "c_name", F.lit('"'))).alias("code"),
        fn.strip_number_suffix(
            F.concat("c_name", F.lit(" ("), nation, F.lit(")"))
        ).alias("display"),
        fn.whole_number(
            F.concat(nation, F.when(F.col("c_nationkey") < 10, ".0").otherwise(".5"))
        ).alias("whole"),
    )


@registered(
    f"""
    SELECT o_orderkey, coalesce(nullif(CASE o_orderstatus WHEN 'P' THEN '' ELSE o_orderstatus END,
               ''), o_orderpriority) AS first_value,
           CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'late_and_low'
                WHEN o_orderstatus = 'F' THEN 'late' WHEN o_orderpriority = '5-LOW' THEN 'low'
                ELSE '' END AS flags,
           lower(o_orderpriority) AS key, split_part(o_orderpriority, '-', 1) AS token,
           json_extract_string('["' || o_orderstatus || '"]', '$[0]') AS first_json
    FROM orders"""
)
def scalar_helpers(t, spark):
    status = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))
    flags = {"late": F.col("o_orderstatus") == "F", "low": F.col("o_orderpriority") == "5-LOW"}
    return t("orders").select(
        "o_orderkey",
        fn.first_nonblank(status, "o_orderpriority").alias("first_value"),
        fn.label_from_flags(flags).alias("flags"),
        fn.norm_key(F.concat(F.lit(" \t"), "o_orderpriority", F.lit(" "))).alias("key"),
        fn.first_token("o_orderpriority", "-").alias("token"),
        fn.json_first(F.to_json(F.array("o_orderstatus"))).alias("first_json"),
    )


# ---- one row per key -------------------------------------------------------------------------


@registered(
    """
    SELECT user_id, event_type, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1"""
)
def keep_latest_event(t, spark):
    rows = t("events").select("user_id", "event_type", "event_id", "ts", "value")
    return op.keep_latest(rows, ["user_id", "event_type"], ["ts"], ["event_id"]).drop("ts")


@registered(
    """
    SELECT user_id, event_type, min(ts::date)::varchar AS first_date,
           max(ts::date)::varchar AS last_date, count(*) AS n_events,
           arg_max(value, (ts::date, event_id)) AS value,
           arg_max(event_id, (ts::date, event_id)) AS event_id
    FROM events GROUP BY ALL"""
)
def diary_rollup(t, spark):
    rows = t("events").withColumn("day", F.to_date("ts"))
    return op.latest_with_bounds(
        rows, ["user_id", "event_type"], "day", ["event_id", "value"], count="n_events"
    )


@registered(
    """
    SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_returnflag FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_partkey
        ORDER BY CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END, l_orderkey,
                 l_linenumber, l_suppkey, l_quantity, l_shipdate) = 1"""
)
def best_source_row(t, spark):
    rank = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 2)
    order = [
        rank.otherwise(3), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey"),
        F.col("l_quantity"), F.col("l_shipdate"),
    ]
    best = op.first_per_key(t("lineitem"), ["l_partkey"], order)
    return best.select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")


# ---- tokens ----------------------------------------------------------------------------------

COLOURS = ["('red', 'Warm')", "('hot', 'Warm')", "('blue', 'Cold')", "('Cold', 'Cold')",
           "('bolt', 'Hardware')", "('gear', 'Hardware')", "('ring', NULL)"]


def _colours(spark):
    names = values(spark, "raw, label", *COLOURS)
    return op.unique_lookup(names, {"token_key": fn.norm_key("raw")}, ["label"])


def _colour_sql(distinct: str) -> str:
    return f"""
    SELECT p_partkey, string_agg({distinct} label, ',' ORDER BY label) AS labels
    FROM part LEFT JOIN (SELECT p_partkey AS pk, unnest(string_split(p_name, ' ')) AS token
                         FROM part) ON pk = p_partkey
    LEFT JOIN (VALUES {', '.join(COLOURS)}) m(raw, label) ON lower(raw) = lower(token)
    GROUP BY p_partkey"""


@registered(_colour_sql("DISTINCT"))
def token_map_csv(t, spark):
    rows = t("part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit(", ")).alias("n"))
    tokens = fn.split_csv("n")
    return op.map_tokens(rows, tokens, _colours(spark), "labels", ["p_partkey"]).drop("n")


@registered(_colour_sql(""))
def token_map_json_repeated(t, spark):
    rows = t("part").select("p_partkey", F.to_json(F.split("p_name", " ")).alias("n"))
    return op.map_tokens(
        rows, fn.split_json("n"), _colours(spark), "labels", ["p_partkey"], distinct=False
    ).drop("n")


@registered(_colour_sql("DISTINCT"))
def token_map_joined(t, spark):
    """A mapping of many more rows gives the same labels."""
    rows = t("part").select("p_partkey", F.split("p_name", " ").alias("n"))
    more = t("customer").select(
        F.concat(F.lit("unused "), "c_custkey").alias("token_key"), F.lit("Other").alias("label")
    )
    mapping = _colours(spark).select("token_key", "label").union(more)
    return op.map_tokens(rows, F.col("n"), mapping, "labels", ["p_partkey"]).drop("n")


@registered(
    f"""
    WITH said AS (SELECT p_size, unnest(string_split(p_name, ' ')) AS token FROM part),
         grouped AS (SELECT p_size, string_agg(label, ',' ORDER BY label) AS every,
                            string_agg(DISTINCT label, ',' ORDER BY label) AS once
                     FROM said JOIN (VALUES {', '.join(COLOURS)}) m(raw, label)
                          ON lower(raw) = lower(token) GROUP BY p_size)
    SELECT p_partkey, p.p_size, every, once FROM part p LEFT JOIN grouped g ON p.p_size = g.p_size"""
)
def token_map_repeated_id(t, spark):
    """Rows that share an id get the labels of all of them."""
    rows = t("part").select("p_partkey", "p_size", F.split("p_name", " ").alias("n"))
    both = op.map_tokens(rows, F.col("n"), _colours(spark), "once", ["p_size"])
    both = op.map_tokens(both, F.col("n"), _colours(spark), "every", ["p_size"], distinct=False)
    return both.drop("n")


# ---- matching --------------------------------------------------------------------------------


@registered(
    """
    WITH shelf AS (
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CASE WHEN l_returnflag <> 'N' THEN l_partkey END AS code,
               l_suppkey % 50 AS size_key, 'F' || l_linestatus AS line_key
        FROM lineitem),
    catalogue AS (
        SELECT p_partkey AS cat_id, CASE WHEN p_type <> 'PROMO' THEN p_partkey END AS code,
               p_size AS size_key, CASE WHEN p_brand = 'Brand#1' THEN 'FO' ELSE 'FF' END AS line_key
        FROM part),
    first AS (
        SELECT s.*, (SELECT min(cat_id) FROM catalogue c WHERE c.code = s.code) AS cat_id
        FROM shelf s WHERE s.code IN (SELECT code FROM catalogue)),
    open_cat AS (SELECT * FROM catalogue c WHERE NOT EXISTS (
        FROM shelf s WHERE s.code = c.code)),
    second AS (
        SELECT s.*, (SELECT min(cat_id) FROM open_cat c
                     WHERE c.size_key = s.size_key AND c.line_key = s.line_key) AS cat_id
        FROM shelf s WHERE s.code IS NULL OR s.code NOT IN (
            SELECT code FROM catalogue WHERE code IS NOT NULL))
    SELECT 'code' AS match_type, l_orderkey, l_linenumber, cat_id FROM first
    UNION ALL
    SELECT CASE WHEN cat_id IS NOT NULL THEN 'size' END, l_orderkey, l_linenumber, cat_id FROM second
    UNION ALL
    SELECT 'catalogue only', NULL, NULL, cat_id FROM open_cat c WHERE NOT EXISTS (
        FROM second s WHERE s.size_key = c.size_key AND s.line_key = c.line_key)"""
)
def two_pass_match(t, spark):
    """Every line of an order against the part catalogue: first by part number, then by size and
    line. Many lines share a key with many parts; no pairs are formed."""
    shelf = t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") != "N", F.col("l_partkey")).alias("code"),
        (F.col("l_suppkey") % 50).alias("size_key"),
        F.concat(F.lit("F"), "l_linestatus").alias("line_key"),
    )
    catalogue = t("part").select(
        F.col("p_partkey").alias("cat_id"),
        F.when(F.col("p_type") != "PROMO", F.col("p_partkey")).alias("code"),
        F.col("p_size").cast("bigint").alias("size_key"),
        F.when(F.col("p_brand") == "Brand#1", "FO").otherwise("FF").alias("line_key"),
    )
    passes = {"code": ["code"], "size": ["size_key", "line_key"]}
    matched, rest = op.match_passes(shelf, catalogue, passes, right_id="cat_id")
    rows = matched.select(
        "match_type", "l_orderkey", "l_linenumber", F.col("right.cat_id").alias("cat_id")
    )
    only = rest.select(F.lit("catalogue only").alias("match_type"), "cat_id")
    return rows.unionByName(only, allowMissingColumns=True)


@registered(
    """
    WITH bought AS (
        SELECT o_custkey AS id, year(o_orderdate) AS year, count(*) AS n_orders,
               arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order
        FROM orders GROUP BY ALL),
    seen AS (
        SELECT user_id AS id, CASE WHEN event_type <> 'error' THEN 1995 + user_id % 5 END AS year,
               count(*) AS n_events
        FROM events GROUP BY ALL),
    people AS (SELECT c_custkey AS id, 1995 + c_custkey % 6 AS year, c_name FROM customer),
    a AS (SELECT coalesce(p.id, b.id) AS id, coalesce(p.year, b.year) AS year, c_name, n_orders,
                 last_order, p.id IS NOT NULL AS has_p, b.id IS NOT NULL AS has_b
          FROM people p FULL JOIN bought b ON p.id = b.id AND p.year = b.year)
    SELECT coalesce(a.id, s.id) AS id, coalesce(a.year, s.year) AS year, c_name, n_orders,
           last_order, n_events,
           concat_ws('_and_', CASE WHEN has_b THEN 'orders' END,
                     CASE WHEN s.id IS NOT NULL THEN 'events' END,
                     CASE WHEN has_p THEN 'people' END) AS source
    FROM a FULL JOIN seen s ON a.id = s.id AND a.year = s.year"""
)
def outer_unify_three(t, spark):
    orders = t("orders").select(
        F.col("o_custkey").alias("id"), F.year("o_orderdate").cast("bigint").alias("year"),
        "o_orderdate", "o_orderkey",
    )
    year = F.when(F.col("event_type") != "error", 1995 + F.col("user_id") % 5)
    events = t("events").select(F.col("user_id").alias("id"), year.alias("year"), "ts", "event_id")
    people = t("customer").select(
        F.col("c_custkey").alias("id"), (1995 + F.col("c_custkey") % 6).alias("year"), "c_name"
    )
    spine = op.fold_histories(
        {"orders": orders, "events": events},
        ["id", "year"],
        latest={"orders": "o_orderdate", "events": "ts"},
        totals={
            "orders": {"n_orders": F.count("orders")},
            "events": {"n_events": F.count("events")},
        },
        base=people,
        base_name="people",
    )
    merged = op.outer_unify(people, "people", spine, ["id", "year"])
    flags = {name: F.col(name).isNotNull() for name in ("orders", "events", "people")}
    return merged.select(
        "id",
        "year",
        F.col("people.c_name").alias("c_name"),
        F.when(flags["orders"], F.col("n_orders")).alias("n_orders"),
        F.col("orders.o_orderkey").alias("last_order"),
        F.when(flags["events"], F.col("n_events")).alias("n_events"),
        fn.label_from_flags(flags).alias("source"),
    )


@registered(
    """
    WITH r AS (
        SELECT c_nationkey AS nation, c_mktsegment AS segment, 1 AS rank, c_name AS name,
               c_custkey AS cust_id, NULL AS supp_id, 'buyer' AS source, 'retail' AS channel,
               2 AS ord FROM customer
        UNION ALL
        SELECT s_nationkey, NULL, 2, s_name, NULL, s_suppkey, 'maker', 'trade', 1 FROM supplier
        UNION ALL
        SELECT c_nationkey, c_mktsegment, 3, 'order ' || o_orderkey, c_custkey, NULL, 'order',
               'trade', 1
        FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT nation, coalesce(segment, 'none') AS segment, arg_min(name, (rank, name)) AS name,
           max(cust_id) AS cust_id, max(supp_id) AS supp_id,
           string_agg(DISTINCT source, ', ' ORDER BY source) AS sources,
           (SELECT string_agg(channel, ', ' ORDER BY ord) FROM (
               SELECT DISTINCT channel, ord FROM r x WHERE x.nation = r.nation
               AND coalesce(x.segment, 'none') = coalesce(r.segment, 'none'))) AS channels,
           count(DISTINCT source) AS n_sources
    FROM r GROUP BY ALL"""
)
def rollup_sources(t, spark):
    customer = t("customer")
    buyers = customer.select(
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"),
        F.lit(1).alias("rank"), F.col("c_name").alias("name"), F.col("c_custkey").alias("cust_id"),
        F.lit("buyer").alias("source"), F.lit("retail").alias("channel"), F.lit(2).alias("ord"),
    )
    makers = t("supplier").select(
        F.col("s_nationkey").alias("nation"), F.lit("none").alias("segment"),
        F.lit(2).alias("rank"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("supp_id"),
        F.lit("maker").alias("source"), F.lit("trade").alias("channel"), F.lit(1).alias("ord"),
    )
    orders = t("orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"),
        F.lit(3).alias("rank"), F.concat(F.lit("order "), "o_orderkey").alias("name"),
        F.col("c_custkey").alias("cust_id"),
        F.lit("order").alias("source"), F.lit("trade").alias("channel"), F.lit(1).alias("ord"),
    )
    rows = buyers.unionByName(makers, allowMissingColumns=True).unionByName(
        orders, allowMissingColumns=True
    )
    return op.rollup_sources(
        rows,
        ["nation", "segment"],
        prefer=["rank", "name"],
        carry=["name"],
        aggregates={
            "cust_id": F.max("cust_id"),
            "supp_id": F.max("supp_id"),
            "sources": joined_set("source"),
            "channels": joined_ranked_set("channel", "ord"),
            "n_sources": F.size(F.collect_set("source")).cast("bigint"),
        },
    )


# ---- lookups ---------------------------------------------------------------------------------


@registered(
    """
    SELECT c_custkey, n_name, coalesce(r_name, n_name) AS country
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 2
    LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'AFRICA'"""
)
def lookup_chain_country(t, spark):
    """Customer to nation to the label of its region, with the raw name as the last resort."""
    nations = op.unique_lookup(
        t("nation").filter("n_regionkey <> 2"),
        {"nation_key": F.col("n_nationkey")}, ["n_name", "n_regionkey"],
    )
    labels = op.unique_lookup(
        t("region").filter("r_name <> 'AFRICA'"), {"region_key": F.col("r_regionkey")}, ["r_name"]
    )
    rows = op.attach(
        t("customer"), nations, {"nation_key": "c_nationkey"},
        {"n_name": "n_name", "n_region": "n_regionkey"},
    )
    rows = op.attach(rows, labels, {"region_key": "n_region"}, {"label": "r_name"})
    return rows.select("c_custkey", "n_name", F.coalesce("label", "n_name").alias("country"))


RATED = ["('BUILDING', 1, 4.5)", "('MACHINERY', 2, 3.0)", "(NULL, 3, 2.5)", "(NULL, 4, 1.0)"]


@registered(
    f"""
    SELECT c_custkey, segment, CAST(coalesce(r.rating, 0) AS double) AS rating FROM (
        SELECT c_custkey, c_nationkey,
               CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS segment
        FROM customer)
    LEFT JOIN (VALUES {', '.join(RATED)}) r(seg, nation, rating)
        ON nation = c_nationkey AND seg IS NOT DISTINCT FROM segment"""
)
def null_safe_fallback(t, spark):
    rated = values(spark, "seg, nation, rating", *RATED)
    lookup = op.unique_lookup(
        rated, {"seg_key": F.col("seg"), "nation_key": F.col("nation")}, ["rating"]
    )
    rows = t("customer").select(
        "c_custkey", "c_nationkey",
        F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")).alias("segment"),
    )
    rows = op.attach(
        rows, lookup, {"nation_key": "c_nationkey", "seg_key": "segment"}, {"r": "rating"},
        null_safe=["seg_key"],
    )
    rating = F.coalesce(F.col("r").cast("double"), F.lit(0.0))
    return rows.select("c_custkey", "segment", rating.alias("rating"))


# ---- cross-domain ----------------------------------------------------------------------------

ITEMS_SQL = """
    SELECT 'customers' AS domain, c_custkey AS item_id, c_name AS name, n_name AS country,
           (c_custkey % 11) / cast(2 AS double) AS rating, c_acctbal > 5000 AS consumed
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 3
    UNION ALL
    SELECT 'suppliers', s_suppkey, s_name, n_name, (s_suppkey % 11) / cast(2 AS double),
           s_acctbal > 5000
    FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND n_regionkey <> 3
    UNION ALL
    SELECT 'parts', p_partkey, p_name, NULL,
           CASE WHEN p_size > 25 THEN (p_partkey % 11) / cast(2 AS double) END, p_size > 10
    FROM part"""


def _items(t):
    nation = t("nation").filter("n_regionkey <> 3").select("n_nationkey", "n_name")
    half = F.lit(2.0)
    customers = t("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    suppliers = t("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")

    def shape(df, domain, key, name, country, rating, consumed):
        return df.select(
            F.lit(domain).alias("domain"), F.col(key).alias("item_id"),
            F.col(name).alias("name"), country.cast("string").alias("country"),
            rating.alias("rating"), consumed.alias("is_consumed"),
        )

    return [
        shape(customers, "customers", "c_custkey", "c_name", F.col("n_name"),
              F.col("c_custkey") % 11 / half, F.col("c_acctbal") > 5000),
        shape(suppliers, "suppliers", "s_suppkey", "s_name", F.col("n_name"),
              F.col("s_suppkey") % 11 / half, F.col("s_acctbal") > 5000),
        shape(t("part"), "parts", "p_partkey", "p_name", F.lit(None),
              F.when(F.col("p_size") > 25, F.col("p_partkey") % 11 / half),
              F.col("p_size") > 10),
    ]


def _all_items(t):
    a, b, c = _items(t)
    return a.unionByName(b).unionByName(c)


@registered(
    f"""
    WITH i AS ({ITEMS_SQL})
    SELECT domain, count(*) AS total_items, count(*) FILTER (consumed) AS items_consumed,
           count(*) FILTER (NOT consumed) AS items_pending, count(rating) AS items_rated,
           round(avg(rating), 2) AS avg_rating, count(country) AS items_with_country
    FROM i GROUP BY domain
    UNION ALL SELECT 'nothing yet', 0, 0, 0, 0, NULL, 0"""
)
def media_summary(t, spark):
    domains = ["customers", "suppliers", "parts", "nothing yet"]
    return marts.summarise(_all_items(t), domains, tracked=domains)


@registered(
    f"""
    WITH i AS ({ITEMS_SQL})
    SELECT i.country, domain, item_id, name, rating,
           'N' || lpad(n_nationkey::varchar, 2, '0') AS iso
    FROM i JOIN nation ON n_name = i.country"""
)
def country_index(t, spark):
    codes = t("nation").select(
        "n_name", F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
        .alias("iso"),
    )
    lookup = op.unique_lookup(codes, {"name_key": fn.norm_key("n_name")}, ["iso"])
    spine = _all_items(t).filter("country IS NOT NULL").drop("is_consumed")
    return op.attach(spine, lookup, {"name_key": fn.norm_key("country")}, {"iso": "iso"})


@registered(
    """
    SELECT route, count(*) AS n_parts, sum(p_partkey)::bigint AS keys FROM (
        SELECT p_partkey, CASE WHEN type = 'PROMO' AND lower(p_name) LIKE '%bolt%' THEN 'in'
                               ELSE 'out' END AS route
        FROM (SELECT *, CASE WHEN p_size > 5 THEN p_type END AS type FROM part))
    GROUP BY route"""
)
def routing_filters(t, spark):
    """Every part takes exactly one route, those of unknown type included."""
    parts = t("part").withColumn("type", F.when(F.col("p_size") > 5, F.col("p_type")))
    inside = (F.col("type") == "PROMO") & fn.has_text("p_name", "bolt")
    known = F.coalesce(inside, F.lit(False))
    both = parts.filter(inside).select(F.lit("in").alias("route"), "p_partkey").unionByName(
        parts.filter(~known).select(F.lit("out").alias("route"), "p_partkey")
    )
    return both.groupBy("route").agg(
        F.count(F.lit(1)).alias("n_parts"), F.sum("p_partkey").alias("keys")
    )


# ---- checks ----------------------------------------------------------------------------------


@registered("SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY 1 HAVING count(*) > 1")
def qa_unique(t, spark):
    return checks.unique(t("orders"), "o_custkey")


@registered(
    """SELECT doc_id, lang FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL"""
)
def qa_not_null(t, spark):
    rows = t("documents").select("doc_id", "lang").join(t("labels"), "doc_id", "left")
    return checks.not_null(rows, "quality").select("doc_id", "lang")


@registered(
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F'"""
)
def qa_accepted(t, spark):
    bad = checks.accepted_values(
        t("orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"], F.col("o_orderstatus") == "F"
    )
    return bad.select("o_orderkey", "o_orderpriority")


@registered(
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
       WHERE l_quantity < 5 OR l_quantity > 45"""
)
def qa_between(t, spark):
    bad = checks.between(t("lineitem"), "l_quantity", 5, 45)
    return bad.select("l_orderkey", "l_linenumber", "l_quantity")


@registered(
    """SELECT event_id, user_id FROM events
       WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)"""
)
def qa_relationship(t, spark):
    orphans = checks.relationship(t("events"), "user_id", t("supplier"), "s_suppkey")
    return orphans.select("event_id", "user_id")


@registered(
    """SELECT l_partkey, l_suppkey, count(*) AS n_rows FROM lineitem
       GROUP BY ALL HAVING count(*) > 1"""
)
def qa_unique_combo(t, spark):
    return checks.unique_combination(t("lineitem"), ["l_partkey", "l_suppkey"])


@registered(
    """SELECT lower(p_name) AS p_name_key, count(*) AS n_rows FROM part GROUP BY 1
       HAVING count(*) > 1"""
)
def qa_ci_unique(t, spark):
    spaced = F.concat("p_name", F.lit("\t"))
    mixed = F.when(F.col("p_size") > 25, F.upper("p_name")).otherwise(spaced)
    return checks.case_insensitive_unique(t("part").select(mixed.alias("p_name")), "p_name")


@registered(
    """
    SELECT 'not_null' AS "check", 'lineitem' AS relation, 'l_partkey' AS "column",
           count(*) FILTER (l_partkey IS NULL) AS violations FROM lineitem
    UNION ALL SELECT 'between', 'lineitem', 'l_discount',
           count(*) FILTER (l_discount < 0.02 OR l_discount > 0.08) FROM lineitem
    UNION ALL SELECT 'accepted_values', 'lineitem', 'l_returnflag',
           count(*) FILTER (l_returnflag NOT IN ('A', 'R')) FROM lineitem
    UNION ALL SELECT 'unique', 'lineitem', 'l_orderkey', count(*) FROM (
        SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'unique_combination', 'lineitem', 'l_orderkey, l_linenumber', count(*) FROM (
        SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'relationship', 'lineitem', 'l_suppkey', count(*)
        FROM lineitem WHERE l_suppkey NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'unique', 'customer', 'c_custkey', 0"""
)
def qa_run_checks(t, spark):
    rules = {
        "lineitem": quality.Rules(
            unique=("l_orderkey",), not_null=("l_partkey",),
            between={"l_discount": (0.02, 0.08)}, accepted={"l_returnflag": ["A", "R"]},
            unique_combination=(("l_orderkey", "l_linenumber"),),
            parent={"l_suppkey": ("customer", "c_custkey")},
        ),
        "customer": quality.Rules(unique=("c_custkey",)),
    }
    return quality.run_checks({n: t(n) for n in rules}, rules)


@registered(
    """
    SELECT DISTINCT 'parts' AS domain, token AS raw_genre
    FROM (SELECT unnest(string_split(p_name, ' ')) AS token FROM part)
    WHERE lower(token) NOT IN ('red', 'bolt', 'gear')"""
)
def qa_coverage(t, spark):
    mapping = values(spark, "domain, raw_genre", "('parts', 'Red')", "('parts', ' bolt')",
                     "('parts', 'gear')", "('other', 'blue')")
    seen = t("part").select(
        F.lit("parts").alias("domain"), F.explode(F.split("p_name", " ")).alias("raw_genre")
    )
    return quality.unmapped_tokens(seen, mapping)


@registered(
    f"""
    SELECT 'customers' AS domain, s_name AS title, n_name AS creator
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    WHERE NOT EXISTS (FROM customer JOIN nation n2 ON c_nationkey = n2.n_nationkey
        WHERE replace(lower(c_name), 'customer', 'supplier') = lower(s_name)
          AND n2.n_name = nation.n_name)"""
)
def qa_orphans(t, spark):
    nation = t("nation").select("n_nationkey", "n_name")
    customers = t("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    items = customers.select(
        F.lit("customers").alias("domain"),
        fn.norm_key(F.replace("c_name", F.lit("Customer"), F.lit("supplier"))).alias("title_key"),
        fn.norm_key("n_name").alias("creator_key"),
    )
    suppliers = t("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    ratings = suppliers.select(
        F.lit("customers").alias("domain"),
        F.col("s_name").alias("title"),
        F.col("n_name").alias("author_or_director_or_artist"),
    )
    return quality.orphaned_manual_ratings(items, ratings)


@registered(
    """
    SELECT 'parts' AS domain, lower(title) AS title_key, lower(p_brand) AS creator_key,
           count(*) AS duplicate_count,
           string_agg(DISTINCT title, ' | ' ORDER BY title) AS duplicate_titles,
           string_agg(DISTINCT p_brand, ' | ' ORDER BY p_brand) AS duplicate_creators
    FROM (SELECT p_brand, CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS title
          FROM part)
    GROUP BY ALL HAVING count(*) > 1"""
)
def qa_duplicates(t, spark):
    title = F.when(F.col("p_size") > 25, F.upper("p_name")).otherwise(F.col("p_name"))
    items = t("part").select(
        F.lit("parts").alias("domain"), title.alias("title"), F.col("p_brand").alias("creator"),
        fn.norm_key(title).alias("title_key"), fn.norm_key("p_brand").alias("creator_key"),
    )
    return quality.duplicate_items(items)


@registered(
    """
    SELECT 'parts' AS domain, lower(title) AS title_key, lower(p_brand) AS creator_key,
           count(*) AS duplicate_count,
           string_agg(title, ' | ' ORDER BY title) AS duplicate_titles,
           string_agg(p_brand, ' | ' ORDER BY p_brand) AS duplicate_creators
    FROM (SELECT p_brand, CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS title
          FROM part)
    GROUP BY ALL HAVING count(*) > 1"""
)
def qa_duplicates_copies(t, spark):
    """Every copy is listed, as often as it occurs."""
    title = F.when(F.col("p_size") > 25, F.upper("p_name")).otherwise(F.col("p_name"))
    items = t("part").select(
        F.lit("parts").alias("domain"), title.alias("title"), F.col("p_brand").alias("creator"),
        fn.norm_key(title).alias("title_key"), fn.norm_key("p_brand").alias("creator_key"),
    )
    return quality.duplicate_items(items, repeat_copies=True)


# ---- payloads --------------------------------------------------------------------------------


def _payload(df: DataFrame, kind: str, keep_nulls: bool = False, **fields) -> DataFrame:
    """Land rows as JSON lines in the shared folder and read them as the jobs read payloads. JSON
    repeats its names, so the files are compressed; such a file is one task's, hence their size."""
    spark = df.sparkSession
    path = f"{working_folder(spark)}/landed-{uuid.uuid4().hex}"
    nulls = {"ignoreNullFields": str(not keep_nulls).lower()}
    document = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), nulls)
    landed = df.select(document.alias("value")).write.option("maxRecordsPerFile", PAYLOAD_ROWS)
    landed.text(path, compression="lz4")
    return read_payload(spark, path, kind)


def _artists(key: str):
    def artist(prefix):
        return F.struct(
            F.concat(F.lit(prefix), F.col(key)).alias("id"),
            F.concat(F.lit(f"Artist {prefix}"), F.col(key)).alias("name"),
        )

    return F.array(artist("a"), artist("b"))


STAMP = "epoch_us(timestamp '2024-05-01 09:30:00')"


@registered(
    f"""
    SELECT 'al' || p_partkey AS album_id, p_name AS name,
           'Artist a' || p_size || ', Artist b' || p_size AS artists,
           '["a' || p_size || '","b' || p_size || '"]' AS artist_ids, '2023-06' AS release_date,
           'month' AS release_date_precision,
           CASE WHEN p_type = 'PROMO' THEN '["rock","' || lower(p_type) || '"]' ELSE '[]' END
               AS genres,
           p_size::bigint AS total_tracks, epoch_us(timestamp '2024-03-01 10:00:00') AS added_at,
           {STAMP} AS _extracted_at
    FROM part"""
)
def flatten_saved_albums(t, spark):
    parts = t("part")
    album = F.struct(
        F.concat(F.lit("al"), "p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        _artists("p_size").alias("artists"),
        F.lit("2023-06").alias("release_date"),
        F.lit("month").alias("release_date_precision"),
        F.when(
            F.col("p_type") == "PROMO", F.array(F.lit("rock"), F.lower("p_type"))
        ).alias("genres"),
        F.col("p_size").alias("total_tracks"),
    )
    items = F.array(F.struct(F.lit("2024-03-01T10:00:00Z").alias("added_at"), album.alias("album")))
    pages = _payload(parts, "saved_albums", items=items, next=F.lit(None).cast("string"))
    return payloads.flatten_saved_albums(pages, RUN_AT)


# What each feature of a line is; the same text in both engines.
FEATURE_SQL = {
    "danceability": "cast(l_discount AS double)",
    "energy": "cast(l_tax AS double)",
    "valence": "CASE WHEN l_linenumber <> 3 THEN cast(l_quantity AS double) / 64 END",
    "tempo": "cast(l_quantity AS double) + 60",
    "acousticness": "cast(l_linenumber AS double) / 8",
    "instrumentalness": "CASE WHEN l_returnflag = 'R' THEN cast(0.5 AS double) END",
    "liveness": "cast(l_suppkey AS double) / 1024",
    "speechiness": "cast(l_orderkey % 8 AS double) / 8",
}


@registered(
    f"""
    WITH features AS (
        SELECT 't' || l_partkey AS id, {', '.join(f'{x} AS {c}' for c, x in FEATURE_SQL.items())}
        FROM lineitem WHERE l_returnflag <> 'N'
        QUALIFY row_number() OVER (
            PARTITION BY l_partkey
            ORDER BY {', '.join(f'{c} DESC NULLS LAST' for c in payloads.AUDIO_FEATURES)}) = 1)
    SELECT 't' || l_partkey AS track_id, 'Track ' || l_linenumber AS name,
           'Artist a' || l_suppkey || ', Artist b' || l_suppkey AS artists,
           '["a' || l_suppkey || '","b' || l_suppkey || '"]' AS artist_ids,
           l_orderkey::varchar AS album_id, 'Album ' || l_partkey AS album_name,
           l_quantity::bigint * 1000 AS duration_ms,
           coalesce(l_returnflag = 'R', false) AS explicit, l_linenumber::bigint AS popularity,
           CASE WHEN l_linenumber <> 4 THEN epoch_us(timestamp '2024-01-01 00:00:00') END
               AS added_at,
           features.* EXCLUDE (id), {STAMP} AS _extracted_at
    FROM (SELECT * FROM lineitem WHERE l_linenumber <> 2) LEFT JOIN features
        ON id = 't' || l_partkey"""
)
def flatten_saved_tracks(t, spark):
    """One page per line; line 2 stands for a local file without an id, line 4 has a time that is
    none. Parts that several lines name have several rows of features."""
    lines = t("lineitem")
    has_id = F.col("l_linenumber") != 2
    track = F.struct(
        F.when(has_id, F.concat(F.lit("t"), "l_partkey")).alias("id"),
        F.concat(F.lit("Track "), "l_linenumber").alias("name"),
        _artists("l_suppkey").alias("artists"),
        F.struct(
            F.col("l_orderkey").cast("string").alias("id"),
            F.concat(F.lit("Album "), "l_partkey").alias("name"),
        ).alias("album"),
        (F.col("l_quantity").cast("bigint") * 1000).alias("duration_ms"),
        F.when(F.col("l_returnflag") == "R", F.lit(True)).alias("explicit"),
        F.col("l_linenumber").alias("popularity"),
    )
    when = F.when(F.col("l_linenumber") == 4, "no time").otherwise("2024-01-01T00:00:00Z")
    local_file = F.struct(when.alias("added_at"),
                          F.lit(None).cast(_type_of(lines, track)).alias("track"))
    item = F.struct(when.alias("added_at"), track.alias("track"))
    pages = _payload(lines, "saved_tracks", items=F.array(item, local_file))
    features = lines.filter("l_returnflag <> 'N'").select(
        F.concat(F.lit("t"), "l_partkey").alias("id"),
        *[F.expr(FEATURE_SQL[c]).alias(c) for c in payloads.AUDIO_FEATURES],
    )
    return payloads.flatten_saved_tracks(pages, features, RUN_AT)


def _type_of(df: DataFrame, column):
    return df.select(column.alias("x")).schema["x"].dataType


@registered(
    f"""
    SELECT 'ar' || s_suppkey AS artist_id, s_name AS name, '["rock"]' AS genres,
           s_nationkey::bigint AS popularity,
           CASE WHEN s_acctbal >= 0 THEN s_suppkey END AS followers, {STAMP} AS _extracted_at
    FROM supplier"""
)
def flatten_followed_artists(t, spark):
    followers = F.when(
        F.col("s_acctbal") >= 0, F.struct(F.col("s_suppkey").alias("total"))
    )
    artist = F.struct(
        F.concat(F.lit("ar"), "s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.array(F.lit("rock")).alias("genres"),
        F.col("s_nationkey").alias("popularity"),
        followers.alias("followers"),
    )
    page = F.struct(F.array(artist).alias("items"))
    return payloads.flatten_followed_artists(
        _payload(t("supplier"), "followed_artists", artists=page), RUN_AT
    )


def _media_object(key: str, title: str, genres) -> F.Column:
    ids = F.struct(
        F.col(key).alias("trakt"),
        F.concat(F.lit("s-"), key).alias("slug"),
        F.concat(F.lit("tt"), key).alias("imdb"),
        F.col(key).alias("tmdb"),
    )
    return F.struct(
        F.col(title).alias("title"), (1950 + F.col(key) % 70).alias("year"), ids.alias("ids"),
        genres.alias("genres"), F.lit(90).alias("runtime"), F.lit("fr").alias("country"),
        F.lit("ended").alias("status"), F.lit("Net").alias("network"),
    )


def _watched_sql(kind: str, extra: str) -> str:
    return f"""
    SELECT p_partkey AS trakt_{kind}_id, 's-' || p_partkey AS slug, 'tt' || p_partkey AS imdb_id,
           p_partkey AS tmdb_id, p_name AS title, 1950 + p_partkey % 70 AS release_year,
           p_size::bigint AS plays, epoch_us(timestamp '2024-02-01 20:00:00') AS last_watched_at,
           epoch_us(timestamp '2024-02-02 20:00:00') AS last_updated_at,
           CASE WHEN p_type = 'PROMO' THEN '[]' ELSE '["' || lower(p_type) || '"]' END AS genres,
           90::bigint AS runtime_minutes, {extra} 'fr' AS country, {STAMP} AS _extracted_at
    FROM part"""


def _watched(t, kind):
    parts = t("part")
    genres = F.when(F.col("p_type") != "PROMO", F.array(F.lower("p_type")))
    return _payload(
        parts, f"watched_{kind}s", plays=F.col("p_size"),
        last_watched_at=F.lit("2024-02-01T20:00:00.000Z"),
        last_updated_at=F.lit("2024-02-02T22:00:00.000+02:00"),
        **{kind: _media_object("p_partkey", "p_name", genres)},
    )


@registered(_watched_sql("movie", ""))
def flatten_watched_movies(t, spark):
    return payloads.flatten_watched_movies(_watched(t, "movie"), RUN_AT)


@registered(_watched_sql("show", "'ended' AS status, 'Net' AS network,"))
def flatten_watched_shows(t, spark):
    return payloads.flatten_watched_shows(_watched(t, "show"), RUN_AT)


@registered(
    f"""
    SELECT CASE WHEN kind = 1 THEN 'movie' ELSE 'show' END AS media_type, event_id AS trakt_id,
           's-' || event_id AS slug, 'tt' || event_id AS imdb_id, event_id AS tmdb_id,
           event_type AS title, 1950 + event_id % 70 AS release_year, r AS rating_raw,
           r / cast(2 AS double) AS rating,
           epoch_us(timestamp '2024-02-01 20:00:00') AS rated_at,
           CASE event_type WHEN 'view' THEN '[]' ELSE '["' || event_type || '","drama"]' END
               AS genres,
           90::bigint AS runtime_minutes, 'fr' AS country, {STAMP} AS _extracted_at
    FROM (SELECT *, CASE WHEN event_type <> 'error' THEN 1 + event_id % 10 END AS r FROM events)
    CROSS JOIN (VALUES (1), (2)) k(kind)"""
)
def flatten_ratings(t, spark):
    """Every event rated once as a movie and once as a show; errors carry no rating."""
    events = t("events")
    rating = F.when(F.col("event_type") != "error", 1 + F.col("event_id") % 10)
    genres = F.when(F.col("event_type") != "view", F.array(F.col("event_type"), F.lit("drama")))
    media = _media_object("event_id", "event_type", genres)
    rated_at = F.lit("2024-02-01T20:00:00.000Z")
    movies = _payload(events, "movie_ratings", rating=rating, rated_at=rated_at, movie=media)
    shows = _payload(events, "show_ratings", rating=rating, rated_at=rated_at, show=media)
    return payloads.flatten_ratings(movies, shows, RUN_AT)


@registered(
    f"""
    SELECT conv_id AS item_id, 'album' AS item_type, turn AS tralbum_id, 'a' AS tralbum_type,
           text AS title, CASE role WHEN 'user' THEN 'band ' || conv_id ELSE role END AS artist,
           NULL AS item_url, NULL AS art_url, 'w' || turn AS token, turn::varchar AS added_at,
           {STAMP} AS _extracted_at,
           json_object(
               'Unknown', json_object('a', [2, 1], 'b', json_object('c', true, 'd', NULL)),
               'added_at', '', 'album_title', CASE role WHEN 'user' THEN text ELSE '' END,
               'artist', role, 'band_name', CASE role WHEN 'user' THEN 'band ' || conv_id ELSE '' END,
               'item_id', conv_id, 'item_title', coalesce(text, ''), 'item_type', 'album',
               'purchased', turn::varchar, 'title', coalesce(text, ''), 'token', 'w' || turn,
               'tralbum_id', turn, 'tralbum_type', 'a')::varchar AS raw_json
    FROM conversations"""
)
def flatten_fan_items(t, spark):
    """Turns as shop items: the text sits in one of three title fields, the rest is blank. The kept
    JSON has its keys in order, nested ones too."""
    rows = t("conversations")
    role, text = F.col("role"), F.coalesce("text", F.lit(""))
    nested = F.struct(
        F.struct(F.lit(None).cast("string").alias("d"), F.lit(True).alias("c")).alias("b"),
        F.array(F.lit(2), F.lit(1)).alias("a"),
    )
    item = F.struct(
        F.concat(F.lit("w"), "turn").alias("token"),
        F.col("conv_id").alias("item_id"),
        F.lit("album").alias("item_type"),
        F.lit("a").alias("tralbum_type"),
        F.col("turn").alias("tralbum_id"),
        F.when(role == "user", text).otherwise("").alias("album_title"),
        text.alias("item_title"),
        text.alias("title"),
        F.when(role == "user", F.concat(F.lit("band "), "conv_id")).otherwise("").alias("band_name"),
        role.alias("artist"),
        F.lit("").alias("added_at"),
        F.col("turn").cast("string").alias("purchased"),
        nested.alias("Unknown"),
    )
    pages = _payload(rows, "fan_items", keep_nulls=True, items=F.array(item))
    return payloads.flatten_fan_items(pages, RUN_AT)


# ---- consumer queries ------------------------------------------------------------------------


@registered(
    """SELECT c_name AS creator, count(*) AS n_items FROM orders
       JOIN customer ON o_custkey = c_custkey GROUP BY 1 ORDER BY n_items DESC, creator LIMIT 30"""
)
def top_creators(t, spark):
    return reports.top_creators(
        t("orders"), "o_custkey", t("customer"), "c_custkey", "c_name", 30
    )


@registered(
    """SELECT n_name AS country, count(*) AS n_items FROM customer
       LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey <> 3 GROUP BY 1"""
)
def by_country(t, spark):
    nation = t("nation").filter("n_nationkey <> 3")
    items = t("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return reports.counts_by(items, "n_name", "country")


@registered(
    """SELECT CASE WHEN p_size > 5 THEN (p_size % 11) / cast(2 AS double) END AS rating,
              count(*) AS n_items FROM part GROUP BY 1"""
)
def by_rating(t, spark):
    rating = F.when(F.col("p_size") > 5, F.col("p_size") % 11 / F.lit(2.0))
    return reports.counts_by(t("part"), rating, "rating")


@registered("SELECT p_type AS content_type, count(*) AS n_items FROM part GROUP BY 1")
def by_content_type(t, spark):
    return reports.counts_by(t("part"), "p_type", "content_type")


@registered(
    """SELECT n_name AS country, count(*) AS n_items FROM customer
       JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY n_items DESC, country LIMIT 30"""
)
def top_countries(t, spark):
    items = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return reports.top_k(items, "n_name", "country", 30)


@registered(
    """SELECT p_type AS kind, count(*) AS n_items FROM part GROUP BY 1
       ORDER BY n_items DESC, kind LIMIT 3"""
)
def top_types(t, spark):
    return reports.top_k(t("part"), "p_type", "kind", 3)


@registered(
    """SELECT (floor(year(o_orderdate) / 10) * 10)::bigint AS decade, count(*) AS n_items
       FROM orders GROUP BY 1"""
)
def by_decade(t, spark):
    return reports.counts_by_decade(t("orders"), F.year("o_orderdate"))


@registered("SELECT year(o_orderdate) AS year, count(*) AS n_items FROM orders GROUP BY 1")
def per_year(t, spark):
    return reports.counts_per_year(t("orders"), "o_orderdate")


@registered(
    "SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS n_items FROM lineitem GROUP BY 1"
)
def per_month(t, spark):
    return reports.counts_per_month(t("lineitem"), "l_shipdate")


@registered(
    """SELECT token AS genre, count(*) AS n_items
       FROM (SELECT unnest(string_split(p_name, ' ')) AS token FROM part) GROUP BY 1"""
)
def by_genre(t, spark):
    listed = t("part").select(F.replace("p_name", F.lit(" "), F.lit(",")).alias("genres"))
    return reports.counts_by_genre(listed)


@registered("SELECT o_orderpriority AS media_format, count(*) AS n_items FROM orders GROUP BY 1")
def by_format(t, spark):
    return reports.counts_by_format(
        t("orders").withColumnRenamed("o_orderpriority", "media_format")
    )


@registered(
    """
    SELECT genre, count(*) AS n_rated, round(avg(rating), 2) AS avg_rating FROM (
        SELECT unnest(string_split(p_name, ' ')) AS genre, (p_size % 11) / cast(2 AS double)
            AS rating FROM part WHERE p_size > 5
        UNION ALL
        SELECT lower(c_mktsegment), (c_custkey % 11) / cast(2 AS double) FROM customer)
    GROUP BY 1"""
)
def genre_ratings(t, spark):
    parts = t("part").select(
        F.replace("p_name", F.lit(" "), F.lit(",")).alias("genres"),
        F.when(F.col("p_size") > 5, F.col("p_size") % 11 / F.lit(2.0)).alias("rating"),
    )
    customers = t("customer").select(
        F.lower("c_mktsegment").alias("genre"), (F.col("c_custkey") % 11 / F.lit(2.0)).alias("rating")
    )
    return reports.genre_ratings({"parts": parts, "customers": customers})


@registered(
    """SELECT p_partkey FROM part WHERE contains(' ' || p_name || ' ', ' red ')
       AND p_type = 'PROMO' AND p_retailprice > 905 AND p_size > 10"""
)
def filtered_collection(t, spark):
    items = t("part").select(
        "p_partkey",
        F.replace("p_name", F.lit(" "), F.lit(",")).alias("genres"),
        F.col("p_type").alias("country"),
        F.when(F.col("p_retailprice") > 905, "dear").otherwise("cheap").alias("source"),
        (F.col("p_size") > 10).alias("is_rated"),
        F.lit(True).alias("is_watched"),
    )
    return reports.filter_collection(
        items, "red", "PROMO", "dear", rated_only=True, watched_only=True
    ).select("p_partkey")


WANTED = [str(3 * i) for i in range(1, 60)]


@registered(
    f"""SELECT p_partkey::varchar AS item_id, p_type AS country, p_name AS title
        FROM part WHERE p_type = 'PROMO' AND p_partkey::varchar IN ({str(WANTED)[1:-1]})"""
)
def clustered_items(t, spark):
    """A collection written by country and id, with a filter on the ids, and read by both."""
    items = t("part").select(
        F.col("p_partkey").cast("string").alias("item_id"),
        F.col("p_type").alias("country"),
        F.col("p_name").alias("title"),
    )
    folder = f"{working_folder(spark)}/clustered-{uuid.uuid4().hex}"
    overwrite(clustered(items, "country", "item_id"), f"{folder}/items", bloom=["item_id"])
    stored_items = read_tables(spark, folder, ["items"])["items"]
    wanted = reports.filter_collection(stored_items, country="PROMO")
    return reports.find_items(wanted, "item_id", WANTED)
