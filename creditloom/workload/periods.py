"""Queries: trailing periods from stored states, and sketches of distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.operators.periods import PeriodSpec, add_delivery, fold, trailing_features
from creditloom.operators.spec import FeatureSpec, Segment, block, build_features
from creditloom.session import scratch_folder
from creditloom.workload.analogue import credit_sql, credit_table
from creditloom.workload.registry import Tables, query, sig_sql, with_sig

CARD_PERIODS = PeriodSpec(
    keys=("SK_ID_CURR",),
    period="MONTHS_BALANCE",
    blocks=(
        block("mean", "AMT_BALANCE", "SK_DPD"),
        block("max", "AMT_BALANCE", "SK_DPD"),
        block("min", "AMT_BALANCE"),
        block("sum", "AMT_BALANCE", "SK_DPD"),
        block("size", "AMT_BALANCE"),
        block("var", "AMT_BALANCE", "SK_DPD"),
        block("std", "AMT_BALANCE"),
    ),
    lengths={"LAST12M_": 12, "LAST36M_": 36},
)
#: The month of the last delivery.
CURRENT = -40
INEXACT = ("MEAN", "VAR", "STD")


def _trailing_sql() -> str:
    """The same features from all rows at once."""
    functions = {"mean": "avg", "size": "count", "var": "var_samp", "std": "stddev_samp"}
    names = iter(CARD_PERIODS.names()[1:])
    columns = []
    for length in CARD_PERIODS.lengths.values():
        inside = f"MONTHS_BALANCE > {CURRENT - length}"
        for blk in CARD_PERIODS.blocks:
            for column in blk.columns:
                name = next(names)
                value = f"{functions.get(blk.fn, blk.fn)}({column}) FILTER (WHERE {inside})"
                if blk.fn == "size":
                    value = f"CASE WHEN bool_or({inside}) THEN {value} END"
                if name.rsplit("_", 1)[1] in INEXACT:
                    value = sig_sql(value)
                columns.append(f'{value} AS "{name}"')
    return (
        f"SELECT SK_ID_CURR, {', '.join(columns)} FROM {credit_sql('credit_card_balance')} "
        f"WHERE SK_ID_CURR IS NOT NULL AND MONTHS_BALANCE > {CURRENT - 36} "
        f"AND MONTHS_BALANCE <= {CURRENT} GROUP BY SK_ID_CURR"
    )


@query("agg_incremental_period", _trailing_sql())
def agg_incremental_period(t: Tables) -> DataFrame:
    """Card balances in three deliveries; some rows are late, one delivery is repeated, one folded."""
    root = scratch_folder(t.spark) + "/periods"
    rows = credit_table(t, "credit_card_balance").select(
        "SK_ID_CURR", "SK_ID_PREV", "MONTHS_BALANCE", "AMT_BALANCE", "SK_DPD"
    )
    late = "SK_ID_PREV % 10 = 3 AND MONTHS_BALANCE > -70"
    until = {
        "20000101": "MONTHS_BALANCE <= -64",
        "20001201": "MONTHS_BALANCE > -64 AND MONTHS_BALANCE <= -52",
        "20011201": "MONTHS_BALANCE > -52",
    }
    for delivery, months in until.items():
        kept = f"(({months}) AND NOT ({late}))"
        if delivery == "20011201":
            kept += f" OR ({late})"
        if delivery == "20001201":
            add_delivery(rows.where("SK_DPD = 1"), root, CARD_PERIODS, delivery)  # to be replaced
        add_delivery(rows.where(kept), root, CARD_PERIODS, delivery)
        if delivery == "20001201":
            fold(t.spark, root, CARD_PERIODS, roll_off=CURRENT - 36 + 1)
    found = trailing_features(t.spark, root, CARD_PERIODS, CURRENT)
    return with_sig(found, [n for n in CARD_PERIODS.names() if n.rsplit("_", 1)[1] in INEXACT])


_DISTINCT = FeatureSpec(
    keys=("l_suppkey",),
    segments=(Segment("", (block("nunique", "l_partkey"), block("nunique_sketch", "l_partkey"))),),
)


@query(
    "agg_nunique_sketch",
    """SELECT l_suppkey, count(DISTINCT l_partkey) AS "l_partkey_NUNIQUE", TRUE AS within_3_percent
       FROM lineitem GROUP BY l_suppkey""",
)
def agg_nunique_sketch(t: Tables) -> DataFrame:
    """The sketch's count next to the exact one, and whether they are close."""
    both = build_features(t.lineitem.select("l_suppkey", "l_partkey"), _DISTINCT)
    exact, sketched = F.col("l_partkey_NUNIQUE"), F.col("l_partkey_NUNIQUE_SKETCH")
    return both.select(
        "l_suppkey",
        "l_partkey_NUNIQUE",
        (F.abs(sketched - exact) <= 0.03 * exact).alias("within_3_percent"),
    )


_SKETCHED = PeriodSpec(
    keys=("o_orderpriority",),
    period="year",
    blocks=(block("nunique_sketch", "o_custkey"), block("size", "o_custkey")),
    lengths={"LAST3Y_": 3},
)


@query(
    "agg_nunique_sketch_merged",
    """SELECT o_orderpriority, count(o_custkey) AS "LAST3Y_o_custkey_SIZE",
              TRUE AS within_3_percent
       FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1997 GROUP BY o_orderpriority""",
)
def agg_nunique_sketch_merged(t: Tables) -> DataFrame:
    """Sketches of three yearly deliveries united, against the exact count of all rows."""
    root = scratch_folder(t.spark) + "/sketches"
    rows = t.orders.select("o_orderpriority", "o_custkey", F.year("o_orderdate").alias("year"))
    for year in (1994, 1995, 1996, 1997):
        add_delivery(rows.where(F.col("year") == year), root, _SKETCHED, str(year))
    found = trailing_features(t.spark, root, _SKETCHED, 1997)
    exact = (
        rows.where("year BETWEEN 1995 AND 1997")
        .groupBy("o_orderpriority", "o_custkey")
        .agg(F.lit(1).alias("one"))
        .groupBy("o_orderpriority")
        .agg(F.count("one").alias("exact"))
    )
    apart = F.abs(F.col("LAST3Y_o_custkey_NUNIQUE_SKETCH") - F.col("exact"))
    return found.join(exact, "o_orderpriority").select(
        "o_orderpriority",
        "LAST3Y_o_custkey_SIZE",
        (apart <= 0.03 * F.col("exact")).alias("within_3_percent"),
    )
