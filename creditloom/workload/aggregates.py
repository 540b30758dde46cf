"""Queries: aggregates per key, ordered picks, segments, two-level and peer-group aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.aggregates import Aggregate, ratio_of_sums, register
from creditloom.functions.scalar import named, one_hot
from creditloom.operators import grouped as g
from creditloom.operators import relational as r
from creditloom.operators.spec import FeatureSpec, Segment, block, build_features
from creditloom.workload.joins import _PEER_SQL, PEER_KEYS, peer_rows
from creditloom.workload.registry import (
    Tables,
    cents,
    cents_sql,
    days_before,
    days_sql,
    query,
    sig,
    sig_sql,
    with_sig,
)

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

_ORDERS_SQL = f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
       {cents_sql("o_totalprice")} AS price, {days_sql("o_orderdate")} AS days,
       CASE WHEN o_orderkey % 3 <> 0 THEN {cents_sql("o_totalprice")} END AS paid FROM orders"""


def _orders(t: Tables) -> DataFrame:
    """Orders with whole-number amounts, day offsets and a partly missing amount."""
    price = cents("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        price.alias("price"),
        days_before("o_orderdate").alias("days"),
        F.when(F.col("o_orderkey") % 3 != 0, price).alias("paid"),
    )


def _one_segment(prefix: str, *blocks, **options) -> FeatureSpec:
    return FeatureSpec(("o_custkey",), (Segment(prefix, blocks, **options),))


@query(
    "agg_mean",
    f"""SELECT o_custkey, avg(price) AS "ORD_price_MEAN", avg(days) AS "ORD_days_MEAN",
               avg(paid) AS "ORD_paid_MEAN" FROM ({_ORDERS_SQL}) GROUP BY o_custkey""",
)
def agg_mean(t: Tables) -> DataFrame:
    return build_features(_orders(t), _one_segment("ORD_", block("mean", "price", "days", "paid")))


@query(
    "agg_min",
    f"""SELECT o_custkey, min(price) AS "ORD_price_MIN", min(paid) AS "ORD_paid_MIN"
        FROM ({_ORDERS_SQL}) GROUP BY o_custkey""",
)
def agg_min(t: Tables) -> DataFrame:
    return build_features(_orders(t), _one_segment("ORD_", block("min", "price", "paid")))


@query(
    "agg_max",
    f"""SELECT o_custkey, max(price) AS "ORD_price_MAX", max(days) AS "ORD_days_MAX"
        FROM ({_ORDERS_SQL}) GROUP BY o_custkey""",
)
def agg_max(t: Tables) -> DataFrame:
    return build_features(_orders(t), _one_segment("ORD_", block("max", "price", "days")))


@query(
    "agg_sum",
    f"""SELECT o_custkey, CAST(sum(price) AS BIGINT) AS "ORD_price_SUM",
               CAST(sum(paid) AS BIGINT) AS "ORD_paid_SUM"
        FROM ({_ORDERS_SQL}) GROUP BY o_custkey""",
)
def agg_sum(t: Tables) -> DataFrame:
    return build_features(_orders(t), _one_segment("ORD_", block("sum", "price", "paid")))


@query(
    "agg_count",
    f"""SELECT o_custkey, count(o_orderkey) AS "ORD_o_orderkey_SIZE",
               count(paid) AS "ORD_paid_SIZE" FROM ({_ORDERS_SQL}) GROUP BY o_custkey""",
)
def agg_count(t: Tables) -> DataFrame:
    return build_features(_orders(t), _one_segment("ORD_", block("size", "o_orderkey", "paid")))


@query(
    "agg_nunique",
    """SELECT l_orderkey, count(DISTINCT nullif(flag, '')) AS "LINE_flag_NUNIQUE",
              count(DISTINCT l_suppkey) AS "LINE_l_suppkey_NUNIQUE"
       FROM (SELECT *, CASE l_linenumber % 4 WHEN 0 THEN '' WHEN 1 THEN NULL
                       ELSE l_returnflag END AS flag FROM lineitem) GROUP BY l_orderkey""",
)
def agg_nunique(t: Tables) -> DataFrame:
    flag = "CASE l_linenumber % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE l_returnflag END"
    lines = t.lineitem.select("l_orderkey", "l_suppkey", F.expr(flag).alias("flag"))
    spec = FeatureSpec(("l_orderkey",), (Segment("LINE_", (block("nunique", "flag", "l_suppkey"),)),))
    return build_features(lines, spec)


_STATUS_KEYS = ("o_custkey", "o_orderstatus")


@query(
    "agg_var_samp",
    f"""SELECT o_custkey, o_orderstatus, {sig_sql("var_samp(price)")} AS "ORD_price_VAR"
        FROM ({_ORDERS_SQL}) GROUP BY o_custkey, o_orderstatus""",
)
def agg_var_samp(t: Tables) -> DataFrame:
    spec = FeatureSpec(_STATUS_KEYS, (Segment("ORD_", (block("var", "price"),)),))
    return with_sig(build_features(_orders(t), spec), ["ORD_price_VAR"])


@query(
    "agg_stddev_samp",
    f"""SELECT o_custkey, o_orderstatus, {sig_sql("stddev_samp(price)")} AS "ORD_price_STD"
        FROM ({_ORDERS_SQL}) GROUP BY o_custkey, o_orderstatus""",
)
def agg_stddev_samp(t: Tables) -> DataFrame:
    spec = FeatureSpec(_STATUS_KEYS, (Segment("ORD_", (block("std", "price"),)),))
    return with_sig(build_features(_orders(t), spec), ["ORD_price_STD"])


@query(
    "agg_median_lower",
    f"""SELECT o_custkey, coalesce(CAST(quantile_disc(paid, 0.5) AS DOUBLE), 0) AS middle
        FROM ({_ORDERS_SQL}) GROUP BY o_custkey""",
)
def agg_median_lower(t: Tables) -> DataFrame:
    return g.group_median(_orders(t), ["o_custkey"], "paid", "middle").na.fill(0.0, ["middle"])


@query(
    "agg_median_exact",
    f"""SELECT o_custkey, CAST(median(paid) AS DOUBLE) AS middle
        FROM ({_ORDERS_SQL}) GROUP BY o_custkey""",
)
def agg_median_exact(t: Tables) -> DataFrame:
    return g.group_median(_orders(t), ["o_custkey"], "paid", "middle", lower=False)


@query(
    "agg_top3_mean",
    f"""SELECT o_custkey, coalesce(avg(paid), 0) AS top_mean FROM (
          SELECT o_custkey, paid, row_number() OVER (
            PARTITION BY o_custkey ORDER BY paid DESC NULLS LAST) AS place FROM ({_ORDERS_SQL}))
        WHERE place <= 3 GROUP BY o_custkey""",
)
def agg_top3_mean(t: Tables) -> DataFrame:
    return g.top_k_mean(_orders(t), ["o_custkey"], "paid", "top_mean", 3)


@query(
    "agg_max_or_zero",
    f"""SELECT o_custkey, o_orderstatus, coalesce(CAST(max(paid) AS DOUBLE), 0) AS "ORD_paid_MAX"
        FROM ({_ORDERS_SQL}) GROUP BY o_custkey, o_orderstatus""",
)
def agg_max_or_zero(t: Tables) -> DataFrame:
    spec = FeatureSpec(_STATUS_KEYS, (Segment("ORD_", (block("max_or_zero", "paid"),)),))
    return build_features(_orders(t), spec)


@query(
    "agg_first_last",
    f"""WITH lines AS (SELECT l_orderkey, l_quantity, {days_sql("l_shipdate")} AS days,
                              l_linenumber FROM lineitem),
        starts AS (SELECT l_orderkey, l_quantity AS "l_quantity_FIRST", row_number() OVER (
                     PARTITION BY l_orderkey ORDER BY days, l_linenumber, l_quantity) AS place
                   FROM lines),
        ends AS (SELECT l_orderkey, l_quantity AS "l_quantity_LAST", row_number() OVER (
                   PARTITION BY l_orderkey ORDER BY days DESC, l_linenumber DESC,
                                                    l_quantity DESC) AS place FROM lines)
        SELECT l_orderkey, "l_quantity_FIRST", "l_quantity_LAST"
        FROM starts JOIN ends USING (l_orderkey) WHERE starts.place = 1 AND ends.place = 1""",
)
def agg_first_last(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_orderkey", "l_quantity", days_before("l_shipdate").alias("days"), "l_linenumber"
    )
    return g.first_last(
        lines, "l_orderkey", ["days", "l_linenumber"], first=["l_quantity"], last=["l_quantity"]
    )


@query(
    "agg_latest_value",
    f"""SELECT o_custkey, paid AS latest_paid FROM (
          SELECT o_custkey, paid, row_number() OVER (
            PARTITION BY o_custkey ORDER BY days DESC, o_orderkey DESC) AS place
          FROM ({_ORDERS_SQL})) WHERE place = 1""",
)
def agg_latest_value(t: Tables) -> DataFrame:
    return g.latest_value(_orders(t), "o_custkey", "paid", ["days", "o_orderkey"], "latest_paid")


@query(
    "agg_multi_fn",
    f"""SELECT o_custkey, avg(price) AS "ORD_price_MEAN", max(price) AS "ORD_price_MAX"
        FROM ({_ORDERS_SQL}) GROUP BY o_custkey""",
)
def agg_multi_fn(t: Tables) -> DataFrame:
    spec = _one_segment("ORD_", block("mean", "price"), block("max", "price"))
    return build_features(_orders(t), spec)


@query(
    "agg_mixed_spec",
    f"""SELECT o_custkey, count(DISTINCT o_orderpriority) AS "ORD_o_orderpriority_NUNIQUE",
               count(days) AS "ORD_days_SIZE", {sig_sql("var_samp(price)")} AS "ORD_price_VAR",
               coalesce(CAST(quantile_disc(price, 0.5) AS DOUBLE), 0) AS "ORD_price_MEDIAN"
        FROM ({_ORDERS_SQL}) GROUP BY o_custkey""",
)
def agg_mixed_spec(t: Tables) -> DataFrame:
    spec = _one_segment(
        "ORD_",
        block("nunique", "o_orderpriority"),
        block("size", "days"),
        block("var", "price"),
        block("median_lower", "price"),
    )
    return with_sig(build_features(_orders(t), spec), ["ORD_price_VAR"])


@query(
    "agg_sum_all_numeric",
    f"""SELECT l_returnflag, l_linestatus, CAST(sum(l_orderkey) AS BIGINT) AS "l_orderkey_SUM",
               CAST(sum(l_linenumber) AS BIGINT) AS "l_linenumber_SUM",
               sum(l_quantity) AS "l_quantity_SUM", CAST(sum(price) AS BIGINT) AS "price_SUM"
        FROM (SELECT *, {cents_sql("l_extendedprice")} AS price FROM lineitem)
        GROUP BY l_returnflag, l_linestatus""",
)
def agg_sum_all_numeric(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        "l_returnflag",
        "l_linestatus",
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_shipdate",
        cents("l_extendedprice").alias("price"),
    )
    return r.sum_all_numeric(lines, ["l_returnflag", "l_linestatus"], "_SUM")


def _case(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


_FINISHED, _OPEN = "o_orderstatus = 'F'", "o_orderstatus = 'O'"


@query(
    "agg_segment_category",
    f"""SELECT o_custkey, avg({_case(_FINISHED, "price")}) AS "FINISHED_price_MEAN",
               nullif(count({_case(_FINISHED, "o_orderkey")}), 0) AS "FINISHED_o_orderkey_SIZE",
               avg({_case(_OPEN, "price")}) AS "OPEN_price_MEAN",
               min({_case(_OPEN, "days")}) AS "OPEN_days_MIN"
        FROM ({_ORDERS_SQL}) GROUP BY o_custkey""",
)
def agg_segment_category(t: Tables) -> DataFrame:
    spec = FeatureSpec(
        ("o_custkey",),
        (
            Segment(
                "FINISHED_", (block("mean", "price"), block("size", "o_orderkey")), rows=_FINISHED
            ),
            Segment("OPEN_", (block("mean", "price"), block("min", "days")), rows=_OPEN),
        ),
    )
    return build_features(_orders(t), spec)


PERIODS = FeatureSpec(
    ("o_custkey",),
    tuple(
        Segment(
            f"LAST{months}M_",
            (block("mean", "price"), block("max", "price"), block("size", "o_orderkey")),
            rows=f"days >= -{30 * months}",
        )
        for months in (6, 12, 24)
    ),
)


def _period_sql(months: int) -> str:
    recent = f"days >= -{30 * months}"
    return (
        f'avg({_case(recent, "price")}) AS "LAST{months}M_price_MEAN", '
        f'max({_case(recent, "price")}) AS "LAST{months}M_price_MAX", '
        f'nullif(count({_case(recent, "o_orderkey")}), 0) AS "LAST{months}M_o_orderkey_SIZE"'
    )


@query(
    "agg_segment_period",
    f"""SELECT o_custkey, {", ".join(map(_period_sql, (6, 12, 24)))}
        FROM ({_ORDERS_SQL}) GROUP BY o_custkey""",
)
def agg_segment_period(t: Tables) -> DataFrame:
    return build_features(_orders(t), PERIODS)


@query(
    "agg_two_level",
    """WITH per_order AS (
         SELECT o_custkey, o_orderkey, max(l_quantity) AS top_quantity, count(*) AS lines
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, o_orderkey)
       SELECT o_custkey, sum(top_quantity) AS top_quantity_sum, avg(lines) AS lines_mean
       FROM per_order GROUP BY o_custkey""",
)
def agg_two_level(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    joined = lines.join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
    return r.two_level(
        joined,
        ["o_custkey", "o_orderkey"],
        {"top_quantity": F.max("l_quantity"), "lines": F.count(F.lit(1))},
        ["o_custkey"],
        {"top_quantity_sum": F.sum("top_quantity"), "lines_mean": F.avg("lines")},
    )


@query(
    "agg_ratio_of_sums",
    f"""SELECT o_custkey, CAST(sum(paid) AS DOUBLE) / nullif(CAST(sum(price) AS DOUBLE), 0)
               AS paid_share FROM ({_ORDERS_SQL}) GROUP BY o_custkey""",
)
def agg_ratio_of_sums(t: Tables) -> DataFrame:
    return _orders(t).groupBy("o_custkey").agg(ratio_of_sums("paid", "price").alias("paid_share"))


@query(
    "agg_peer_group",
    f"""SELECT segment, region, status, priority, band,
               CAST(quantile_disc(price, 0.5) AS DOUBLE) AS price_median,
               avg(price) AS price_mean, {sig_sql("stddev_samp(price)")} AS price_std
        FROM ({_PEER_SQL}) WHERE segment IS NOT NULL AND region IS NOT NULL
             AND status IS NOT NULL AND priority IS NOT NULL AND band IS NOT NULL
        GROUP BY segment, region, status, priority, band""",
)
def agg_peer_group(t: Tables) -> DataFrame:
    rows = peer_rows(t).na.drop(subset=PEER_KEYS)
    totals = {"price_mean": F.avg("price"), "price_std": sig(F.stddev_samp("price"))}
    return g.group_median(rows, PEER_KEYS, "price", "price_median", totals=totals)


@query(
    "agg_flag_share",
    "SELECT o_custkey, "
    + ", ".join(
        f"avg(CASE WHEN priority IS NULL THEN NULL WHEN priority = '{p}' THEN 1 ELSE 0 END) "
        f'AS "ORD_priority_{p}_MEAN"'
        for p in PRIORITIES
    )
    + " FROM (SELECT o_custkey, nullif(o_orderpriority, '2-HIGH') AS priority FROM orders) "
    "GROUP BY o_custkey",
)
def agg_flag_share(t: Tables) -> DataFrame:
    orders = t.orders.select(
        "o_custkey", F.nullif("o_orderpriority", F.lit("2-HIGH")).alias("priority")
    )
    flags = one_hot("priority", PRIORITIES, null_as_zero=False)
    return build_features(orders.withColumns(flags), _one_segment("ORD_", block("mean", *flags)))


@query(
    "proj_rename_pattern",
    f"""SELECT o_custkey, min(price) AS "CARD: (a, b)/c price_MIN",
               max(price) AS "CARD: (a, b)/c price_MAX"
        FROM ({_ORDERS_SQL}) GROUP BY o_custkey""",
)
def proj_rename_pattern(t: Tables) -> DataFrame:
    spec = _one_segment("CARD: (a, b)/c ", block("min", "price"), block("max", "price"))
    return build_features(_orders(t), spec)


def _second_largest(rows: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    place = F.row_number().over(
        Window.partitionBy(*map(named, keys)).orderBy(named(column).desc_nulls_last())
    )
    return rows.withColumn("__place", place).where("__place = 2").select(
        *map(named, keys), named(column).alias(out)
    )


@query(
    "agg_registered",
    f"""SELECT o_custkey, second AS "ORD_price_SECOND", total AS "ORD_price_TOTAL"
        FROM (SELECT o_custkey, CAST(sum(DISTINCT price) AS BIGINT) AS total
              FROM ({_ORDERS_SQL}) GROUP BY o_custkey)
        LEFT JOIN (SELECT o_custkey, price AS second FROM (
                     SELECT o_custkey, price, row_number() OVER (
                       PARTITION BY o_custkey ORDER BY price DESC NULLS LAST) AS place
                     FROM ({_ORDERS_SQL})) WHERE place = 2) USING (o_custkey)""",
)
def agg_registered(t: Tables) -> DataFrame:
    """Aggregates that a user adds: one by rank, one over distinct values."""
    register("second", Aggregate("SECOND", execution="ranked", operator=_second_largest))
    register("distinct_sum", Aggregate("TOTAL", "sum({})", execution="distinct"))
    spec = _one_segment("ORD_", block("second", "price"), block("distinct_sum", "price"))
    return build_features(_orders(t), spec)
