"""Queries: joins, join-backs, peer buckets, semi-joins, feature assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.operators import relational as r
from creditloom.operators.spec import FeatureSpec, Segment, block, build_features
from creditloom.workload.registry import (
    Tables,
    cents,
    cents_sql,
    days_before,
    days_sql,
    months_before,
    months_sql,
    query,
    sig,
    sig_sql,
    with_sig,
)


@query(
    "join_inner",
    """SELECT l_orderkey, l_linenumber, o_custkey, l_quantity
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def join_inner(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return lines.join(orders, "l_orderkey")


@query(
    "join_left",
    """SELECT o_orderkey, n.lines FROM orders LEFT JOIN (
         SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY l_orderkey) n
       ON o_orderkey = l_orderkey""",
)
def join_left(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("lines")
    )
    return t.orders.select("o_orderkey").join(lines, "o_orderkey", "left")


_PEER_SQL = f"""SELECT nullif(c_mktsegment, 'MACHINERY') AS segment,
       nullif(n_regionkey, 2) AS region, o_orderstatus AS status, o_orderpriority AS priority,
       CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band,
       {cents_sql("o_totalprice")} AS price
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
PEER_KEYS = ["segment", "region", "status", "priority", "band"]


def peer_rows(t: Tables) -> DataFrame:
    orders = t.orders.select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        cents("o_totalprice").alias("price"),
    )
    band = F.expr("CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END")
    customers = t.customer.select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment"),
        F.col("c_nationkey").alias("n_nationkey"),
        band.alias("band"),
    )
    nations = t.nation.select("n_nationkey", F.nullif("n_regionkey", F.lit(2)).alias("region"))
    return orders.join(customers, "c_custkey").join(nations, "n_nationkey").select(
        *PEER_KEYS, "price"
    )


@query(
    "join_multi_key",
    f"""WITH peers AS ({_PEER_SQL}),
        sizes AS (SELECT segment, region, status, priority, band, count(*) AS members,
                         avg(price) AS price_mean FROM peers GROUP BY ALL),
        spreads AS (SELECT segment, region, status, priority, band,
                           {sig_sql("stddev_samp(price)")} AS price_std FROM peers GROUP BY ALL)
        SELECT segment, region, status, priority, band, members, price_mean, price_std
        FROM sizes JOIN spreads USING (segment, region, status, priority, band)""",
)
def join_multi_key(t: Tables) -> DataFrame:
    # Both aggregates have the same grain, so the inner join on five nullable keys is one
    # aggregation without the groups that have a NULL key.
    return (
        peer_rows(t)
        .na.drop(subset=PEER_KEYS)
        .groupBy(*PEER_KEYS)
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.avg("price").alias("price_mean"),
            sig(F.stddev_samp("price")).alias("price_std"),
        )
    )


@query(
    "join_agg_back",
    f"""WITH lines AS (SELECT l_orderkey, nullif(l_linenumber, 3) AS line,
                              {cents_sql("l_extendedprice")} AS price FROM lineitem)
        SELECT l.l_orderkey, l.line, l.price, p.line_total, o.order_total, o.order_max
        FROM lines l
        LEFT JOIN (SELECT l_orderkey, line, CAST(sum(price) AS BIGINT) AS line_total
                   FROM lines GROUP BY l_orderkey, line) p
          ON l.l_orderkey = p.l_orderkey AND l.line = p.line
        LEFT JOIN (SELECT l_orderkey, CAST(sum(price) AS BIGINT) AS order_total,
                          max(price) AS order_max FROM lines GROUP BY l_orderkey) o
          ON l.l_orderkey = o.l_orderkey""",
)
def join_agg_back(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_orderkey",
        F.nullif("l_linenumber", F.lit(3)).alias("line"),
        cents("l_extendedprice").alias("price"),
    )
    per_line = r.with_group_total(lines, ["l_orderkey", "line"], {"line_total": F.sum("price")})
    return r.with_group_total(
        per_line,
        ["l_orderkey"],
        {"order_total": F.sum("price"), "order_max": F.max("price")},
    ).select("l_orderkey", "line", "price", "line_total", "order_total", "order_max")


@query(
    "peer_bucket_mean",
    f"""WITH sized AS (
          SELECT o_orderkey, {cents_sql("o_totalprice")} AS price, nullif(n.lines, 2) AS bucket
          FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS lines FROM lineitem
                                 GROUP BY l_orderkey) n ON o_orderkey = l_orderkey)
        SELECT s.o_orderkey, s.bucket, s.price, p.peer_price
        FROM sized s LEFT JOIN (SELECT bucket, avg(price) AS peer_price FROM sized
                                GROUP BY bucket) p ON s.bucket = p.bucket""",
)
def peer_bucket_mean(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("lines")
    )
    sized = (
        t.orders.select("o_orderkey", cents("o_totalprice").alias("price"))
        .join(lines, "o_orderkey", "left")
        .select("o_orderkey", F.nullif("lines", F.lit(2)).alias("bucket"), "price")
    )
    return r.with_peer_means(sized, "bucket", ["price"], "peer_").select(
        "o_orderkey", "bucket", "price", "peer_price"
    )


_LINES_SQL = f"""SELECT l_orderkey, l_linenumber, l_quantity,
       {months_sql("l_shipdate")} AS months FROM lineitem"""


def _monthly_lines(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", months_before("l_shipdate").alias("months")
    )


@query(
    "latest_rows",
    f"""WITH lines AS ({_LINES_SQL})
        SELECT * FROM lines WHERE (l_orderkey, months) IN (
          SELECT (l_orderkey, max(months)) FROM lines GROUP BY l_orderkey)""",
)
def latest_rows(t: Tables) -> DataFrame:
    return r.latest_rows(_monthly_lines(t), "l_orderkey", "months").select(
        "l_orderkey", "l_linenumber", "l_quantity", "months"
    )


@query(
    "semi_recent_loans",
    f"""WITH lines AS ({_LINES_SQL})
        SELECT * FROM lines WHERE l_orderkey IN (
          SELECT l_orderkey FROM lines WHERE months > -12)""",
)
def semi_recent_loans(t: Tables) -> DataFrame:
    return r.with_activity_in(_monthly_lines(t), "l_orderkey", "months", 12)


@query(
    "semi_single_loan_clients",
    f"""WITH dated AS (SELECT o_custkey, o_orderkey, {days_sql("o_orderdate")} AS days FROM orders)
        SELECT * FROM dated WHERE o_custkey IN (
          SELECT o_custkey FROM dated WHERE days >= -540
          GROUP BY o_custkey HAVING count(DISTINCT o_orderkey) = 1)""",
)
def semi_single_loan_clients(t: Tables) -> DataFrame:
    dated = t.orders.select("o_custkey", "o_orderkey", days_before("o_orderdate").alias("days"))
    return r.with_single_member_in(dated, "o_custkey", "o_orderkey", "days", 540)


@query(
    "semi_late_loans",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE EXISTS (
         SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity - 25 > 0)""",
)
def semi_late_loans(t: Tables) -> DataFrame:
    due = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return r.with_event(orders, due, "o_orderkey", F.col("l_quantity") - 25 > 0)


_ASSEMBLY = FeatureSpec(
    keys=("o_custkey",),
    segments=(
        Segment("ALL_", (block("mean", "price"), block("nunique", "o_orderkey"))),
        Segment(
            "FINISHED_",
            (block("sum", "price"), block("size", "o_orderkey"), block("nunique", "o_orderpriority")),
            rows="o_orderstatus = 'F'",
        ),
        Segment(
            "RECENT_",
            (block("max", "price"), block("var", "price"), block("size", "o_orderkey")),
            rows="days >= -360",
        ),
    ),
)


@query(
    "feature_assembly",
    f"""WITH dated AS (SELECT *, {cents_sql("o_totalprice")} AS price,
                              {days_sql("o_orderdate")} AS days FROM orders),
        everything AS (SELECT o_custkey, avg(price) AS "ALL_price_MEAN",
                              count(DISTINCT o_orderkey) AS "ALL_o_orderkey_NUNIQUE"
                       FROM dated GROUP BY o_custkey),
        finished AS (SELECT o_custkey, CAST(sum(price) AS BIGINT) AS "FINISHED_price_SUM",
                            count(o_orderkey) AS "FINISHED_o_orderkey_SIZE",
                            count(DISTINCT o_orderpriority) AS "FINISHED_o_orderpriority_NUNIQUE"
                     FROM dated WHERE o_orderstatus = 'F' GROUP BY o_custkey),
        recent AS (SELECT o_custkey, max(price) AS "RECENT_price_MAX",
                          {sig_sql("var_samp(price)")} AS "RECENT_price_VAR",
                          count(o_orderkey) AS "RECENT_o_orderkey_SIZE"
                   FROM dated WHERE days >= -360 GROUP BY o_custkey)
        SELECT * FROM everything LEFT JOIN finished USING (o_custkey)
               LEFT JOIN recent USING (o_custkey)""",
)
def feature_assembly(t: Tables) -> DataFrame:
    orders = t.orders.withColumns(
        {"price": cents("o_totalprice"), "days": days_before("o_orderdate")}
    )
    return with_sig(build_features(orders, _ASSEMBLY), ["RECENT_price_VAR"])
