"""Queries: projections, filters, missing values, encodings, row statistics, sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions import scalar as s
from creditloom.functions.sql_functions import register
from creditloom.operators.relational import distinct_keys, union_all
from creditloom.workload.registry import Tables, days_before, days_sql, query, sig, sig_sql

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
LINE = ("l_orderkey", "l_linenumber")


@query("proj_select_drop", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def proj_select_drop(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment").drop(
        "c_acctbal"
    )


@query(
    "proj_diff",
    "SELECT l_orderkey, l_linenumber, l_extendedprice - l_quantity AS price_less_quantity "
    "FROM lineitem",
)
def proj_diff(t: Tables) -> DataFrame:
    return t.lineitem.select(
        *LINE, s.difference("l_extendedprice", "l_quantity").alias("price_less_quantity")
    )


@query(
    "proj_safe_ratio",
    """SELECT l_orderkey, l_linenumber,
              l_extendedprice / nullif(l_discount, 0) AS price_per_discount,
              nullif(l_quantity, 10) / nullif(l_tax, 0) AS quantity_per_tax
       FROM lineitem""",
)
def proj_safe_ratio(t: Tables) -> DataFrame:
    quantity = F.nullif(F.col("l_quantity"), F.lit(10))
    return t.lineitem.select(
        *LINE,
        s.safe_ratio("l_extendedprice", "l_discount").alias("price_per_discount"),
        s.safe_ratio(quantity, "l_tax").alias("quantity_per_tax"),
    )


@query(
    "proj_simple_interest",
    """WITH loan AS (
         SELECT l_orderkey, l_linenumber, l_extendedprice * l_discount AS annuity,
                l_extendedprice AS credit, CAST(l_linenumber - 1 AS DOUBLE) AS payments
         FROM lineitem)
       SELECT l_orderkey, l_linenumber,
              annuity / nullif(credit, 0)
                - payments / nullif(payments, 0) / nullif(payments, 0) AS interest
       FROM loan""",
)
def proj_simple_interest(t: Tables) -> DataFrame:
    annuity = F.col("l_extendedprice") * F.col("l_discount")
    payments = (F.col("l_linenumber") - 1).cast("double")
    return t.lineitem.select(
        *LINE, s.simple_interest(annuity, "l_extendedprice", payments).alias("interest")
    )


@query(
    "proj_indicator",
    """SELECT l_orderkey, l_linenumber,
              CASE WHEN l_discount > 0.05e0 THEN 1 ELSE 0 END AS big_discount,
              CASE WHEN nullif(l_tax, 0) > 0.04e0 THEN 1
                   WHEN nullif(l_tax, 0) <= 0.04e0 THEN 0 END AS big_tax
       FROM lineitem""",
)
def proj_indicator(t: Tables) -> DataFrame:
    tax = F.nullif(F.col("l_tax"), F.lit(0.0))
    return t.lineitem.select(
        *LINE,
        s.indicator(F.col("l_discount") > 0.05).alias("big_discount"),
        s.indicator(tax > 0.04).alias("big_tax"),
    )


@query(
    "proj_truthy",
    """SELECT l_orderkey, l_linenumber,
              CASE WHEN l_discount <> 0 THEN 1 ELSE 0 END AS has_discount,
              CASE WHEN nullif(l_linenumber, 2) - 1 <> 0 THEN 1
                   WHEN nullif(l_linenumber, 2) - 1 = 0 THEN 0 END AS not_first
       FROM lineitem""",
)
def proj_truthy(t: Tables) -> DataFrame:
    position = F.nullif(F.col("l_linenumber"), F.lit(2)) - 1
    return t.lineitem.select(
        *LINE, s.truthy("l_discount").alias("has_discount"), s.truthy(position).alias("not_first")
    )


@query(
    "proj_try_cast",
    """SELECT p_partkey, TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand_number,
              TRY_CAST(p_name AS INTEGER) AS name_number
       FROM part""",
)
def proj_try_cast(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        s.lenient_cast(F.substring("p_brand", 7, 10), "int").alias("brand_number"),
        s.lenient_cast("p_name", "int").alias("name_number"),
    )


@query(
    "proj_row_sum",
    """SELECT l_orderkey, l_linenumber,
              l_quantity + nullif(l_discount, 0) + l_tax AS total FROM lineitem""",
)
def proj_row_sum(t: Tables) -> DataFrame:
    discount = F.nullif(F.col("l_discount"), F.lit(0.0))
    return t.lineitem.select(*LINE, s.row_sum(["l_quantity", discount, "l_tax"]).alias("total"))


@query(
    "filter_predicate_3vl",
    """SELECT o_orderkey, known_status FROM (
         SELECT o_orderkey, nullif(o_orderstatus, 'P') AS known_status FROM orders)
       WHERE known_status <> 'F'""",
)
def filter_predicate_3vl(t: Tables) -> DataFrame:
    known = F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("known_status")
    return t.orders.select("o_orderkey", known).where("known_status != 'F'")


@query(
    "filter_column_expr",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'",
)
def filter_column_expr(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderstatus") == "O").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query(
    "filter_trailing_period",
    f"""SELECT o_orderkey, {days_sql("o_orderdate")} AS days FROM orders
        WHERE {days_sql("o_orderdate")} >= -360""",
)
def filter_trailing_period(t: Tables) -> DataFrame:
    dated = t.orders.select("o_orderkey", days_before("o_orderdate").alias("days"))
    return dated.where(s.within_trailing("days", 360))


@query(
    "null_fill",
    "SELECT p_partkey, coalesce(nullif(p_size, 10), 365243) AS size_filled FROM part",
)
def null_fill(t: Tables) -> DataFrame:
    sized = t.part.select("p_partkey", F.nullif("p_size", F.lit(10)).alias("size_filled"))
    return sized.na.fill(365243, ["size_filled"])


@query(
    "null_sentinel",
    """SELECT l_orderkey, l_linenumber,
              CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS INTEGER) END AS days
       FROM lineitem""",
)
def null_sentinel(t: Tables) -> DataFrame:
    recorded = F.when(F.col("l_linenumber") == 7, 365243).otherwise(
        F.col("l_quantity").cast("int")
    )
    return t.lineitem.select(*LINE, s.without_sentinel(recorded, 365243).alias("days"))


_TEXT = "CASE p_size % 4 WHEN 1 THEN '  ' WHEN 2 THEN 'null' WHEN 3 THEN p_type END"


@query(
    "null_text_missing",
    """SELECT p_partkey, p_size % 4 <> 3 AS is_missing,
              CASE WHEN p_size % 4 = 3 THEN p_type END AS kept FROM part""",
)
def null_text_missing(t: Tables) -> DataFrame:
    text = t.part.select("p_partkey", F.expr(_TEXT).alias("text"))
    return text.select(
        "p_partkey", s.text_is_missing("text").alias("is_missing"), s.text_or_null("text").alias("kept")
    )


def _flags_sql(unknown: str) -> str:
    return ", ".join(
        f"CASE WHEN segment = '{x}' THEN 1 WHEN segment IS NULL THEN {unknown} ELSE 0 END "
        f"AS segment_{x}"
        for x in SEGMENTS
    )


_SEGMENT_SQL = (
    "(SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS segment FROM customer)"
)


def _segments(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment")
    )


@query(
    "onehot_null_propagating",
    f"SELECT c_custkey, {_flags_sql('CAST(NULL AS INTEGER)')} FROM {_SEGMENT_SQL}",
)
def onehot_null_propagating(t: Tables) -> DataFrame:
    flags = s.one_hot("segment", SEGMENTS, null_as_zero=False)
    return _segments(t).withColumns(flags).drop("segment")


@query("onehot_zero_filled", f"SELECT c_custkey, {_flags_sql('0')} FROM {_SEGMENT_SQL}")
def onehot_zero_filled(t: Tables) -> DataFrame:
    flags = s.one_hot("segment", SEGMENTS, null_as_zero=True)
    return _segments(t).withColumns(flags).drop("segment")


_BIRTH = "nullif(500 - (c_custkey * 37) % 40000, 500)"


@query(
    "band_age",
    f"""SELECT c_custkey, CASE WHEN years IS NULL THEN NULL WHEN years < 27 THEN 1
               WHEN years < 40 THEN 2 WHEN years < 50 THEN 3 WHEN years < 65 THEN 4
               WHEN years < 99 THEN 5 ELSE 0 END AS age_range
        FROM (SELECT c_custkey, trunc(-({_BIRTH}) / 365e0) AS years FROM customer)""",
)
def band_age(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", s.age_band(F.expr(_BIRTH)).alias("age_range"))


# Three scores with NULLs in every combination.
_SCORES = {
    "a": "CAST(nullif(p_size % 5, 0) AS DOUBLE)",
    "b": "CAST(nullif(p_size % 3, 0) AS DOUBLE)",
    "c": "CAST(nullif(p_partkey % 7, 0) AS DOUBLE)",
}
_SCORES_SQL = (
    "(SELECT p_partkey, " + ", ".join(f"{e} AS {n}" for n, e in _SCORES.items()) + " FROM part)"
)
_ABC = ("a", "b", "c")


def _scores(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", *(F.expr(e).alias(n) for n, e in _SCORES.items()))


@query(
    "sql_row_functions",
    f"""SELECT p_partkey, list_min([a, b, c]) AS lowest, list_max([a, b, c]) AS highest,
               list_avg([a, b, c]) AS average, list_median([a, b, c]) AS middle,
               a * b * c AS product, a / nullif(b, 0) AS ratio, nullif(c, 0) AS known,
               CASE WHEN p_size * 365 < 9855 THEN 1 WHEN p_size * 365 < 14600 THEN 2
                    WHEN p_size * 365 < 18250 THEN 3 ELSE 4 END AS band
        FROM {_SCORES_SQL} JOIN (SELECT p_partkey AS part, p_size FROM part) ON part = p_partkey""",
)
def sql_row_functions(t: Tables) -> DataFrame:
    """Row functions called by name from SQL text."""
    register(t.spark)
    rows = _scores(t).join(t.part.select("p_partkey", "p_size"), "p_partkey")
    return t.spark.sql(
        """SELECT p_partkey, row_min(a, b, c) AS lowest, row_max(a, b, c) AS highest,
                  row_mean(a, b, c) AS average, row_median(a, b, c) AS middle,
                  row_product(a, b, c) AS product, safe_ratio(a, b) AS ratio,
                  without_sentinel(c, 0) AS known, age_band(-p_size * 365) AS band
           FROM {rows}""",
        rows=rows,
    )


@query("row_min", f"SELECT p_partkey, list_min([a, b, c]) AS lowest FROM {_SCORES_SQL}")
def row_min(t: Tables) -> DataFrame:
    return _scores(t).select("p_partkey", s.row_min(_ABC).alias("lowest"))


@query("row_max", f"SELECT p_partkey, list_max([a, b, c]) AS highest FROM {_SCORES_SQL}")
def row_max(t: Tables) -> DataFrame:
    return _scores(t).select("p_partkey", s.row_max(_ABC).alias("highest"))


@query("row_mean", f"SELECT p_partkey, list_avg([a, b, c]) AS average FROM {_SCORES_SQL}")
def row_mean(t: Tables) -> DataFrame:
    return _scores(t).select("p_partkey", s.row_mean(_ABC).alias("average"))


@query("row_product", f"SELECT p_partkey, a * b * c AS product FROM {_SCORES_SQL}")
def row_product(t: Tables) -> DataFrame:
    return _scores(t).select("p_partkey", s.row_product(_ABC).alias("product"))


@query(
    "row_weighted_sum",
    f"SELECT p_partkey, 2 * a + b + 3 * c AS weighted FROM {_SCORES_SQL}",
)
def row_weighted_sum(t: Tables) -> DataFrame:
    weighted = s.row_weighted_sum(_ABC, (2.0, 1.0, 3.0))
    return _scores(t).select("p_partkey", weighted.alias("weighted"))


@query(
    "row_median",
    f"SELECT p_partkey, list_aggregate([a, b, c], 'median') AS middle FROM {_SCORES_SQL}",
)
def row_median(t: Tables) -> DataFrame:
    return _scores(t).select("p_partkey", s.row_median(_ABC).alias("middle"))


@query(
    "row_var_pop",
    "SELECT p_partkey, "
    + sig_sql("list_aggregate([a, b, c], 'var_pop')")
    + f" AS spread FROM {_SCORES_SQL}",
)
def row_var_pop(t: Tables) -> DataFrame:
    return _scores(t).select("p_partkey", sig(s.row_var_pop(_ABC)).alias("spread"))


@query(
    "union_all",
    """SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 2 = 0
       UNION ALL SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 2 = 1
       UNION ALL SELECT s_suppkey, s_acctbal FROM supplier""",
)
def union_all_query(t: Tables) -> DataFrame:
    clients = t.customer.select("c_custkey", "c_acctbal")
    even, odd = clients.where("c_custkey % 2 = 0"), clients.where("c_custkey % 2 = 1")
    suppliers = t.supplier.select(
        F.col("s_acctbal").alias("c_acctbal"), F.col("s_suppkey").alias("c_custkey")
    )
    return union_all(union_all(even, odd), suppliers)


@query("distinct_keys", "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'")
def distinct_keys_query(t: Tables) -> DataFrame:
    return distinct_keys(t.lineitem.where("l_returnflag = 'R'"), ["l_orderkey"])


@query(
    "sort_global",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       ORDER BY o_custkey, o_totalprice DESC, o_orderkey""",
)
def sort_global(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderkey", "o_totalprice").orderBy(
        "o_custkey", F.desc("o_totalprice"), "o_orderkey"
    )
