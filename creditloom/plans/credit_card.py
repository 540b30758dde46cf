"""Credit cards: monthly balance rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.scalar import indicator, one_hot, safe_ratio
from creditloom.functions.vocabulary import CARD_CONTRACT_STATUS
from creditloom.operators.relational import group_table
from creditloom.operators.spec import FeatureSpec, Segment, block, build_features


def _active_within(months: int) -> Segment:
    """All rows of the cards with a row in the last months."""
    return Segment(
        f"INS_{months}M_",
        (
            block("mean", "CNT_DRAWINGS_ATM_CURRENT", "AMT_BALANCE", "LIMIT_USE"),
            block("max", "SK_DPD", "AMT_BALANCE", "LIMIT_USE"),
            block("sum", "SK_DPD"),
        ),
        rows=f"LAST_MONTH > -{months}",
    )


# The names and the order of the published columns.
SPEC = FeatureSpec(
    keys=("SK_ID_CURR",),
    segments=(
        Segment(
            "CC_",
            (
                block(
                    "mean",
                    "AMT_INST_MIN_REGULARITY",
                    "AMT_PAYMENT_TOTAL_CURRENT",
                    "AMT_TOTAL_RECEIVABLE",
                    "CNT_DRAWINGS_ATM_CURRENT",
                    "CNT_DRAWINGS_CURRENT",
                    "CNT_DRAWINGS_POS_CURRENT",
                    "SK_DPD",
                    "LIMIT_USE",
                    "PAYMENT_DIV_MIN",
                ),
                block(
                    "max",
                    "AMT_BALANCE",
                    "AMT_CREDIT_LIMIT_ACTUAL",
                    "AMT_DRAWINGS_ATM_CURRENT",
                    "AMT_DRAWINGS_CURRENT",
                    "AMT_DRAWINGS_POS_CURRENT",
                    "AMT_INST_MIN_REGULARITY",
                    "AMT_PAYMENT_TOTAL_CURRENT",
                    "AMT_TOTAL_RECEIVABLE",
                    "CNT_DRAWINGS_ATM_CURRENT",
                    "CNT_DRAWINGS_CURRENT",
                    "SK_DPD",
                    "SK_DPD_DEF",
                    "LIMIT_USE",
                    "LATE_PAYMENT",
                ),
                block("min", "MONTHS_BALANCE", "PAYMENT_DIV_MIN"),
                block(
                    "sum",
                    "AMT_DRAWINGS_ATM_CURRENT",
                    "AMT_DRAWINGS_CURRENT",
                    "AMT_DRAWINGS_POS_CURRENT",
                    "AMT_PAYMENT_TOTAL_CURRENT",
                    "CNT_DRAWINGS_ATM_CURRENT",
                    "CNT_DRAWINGS_CURRENT",
                    "SK_DPD",
                    "SK_DPD_DEF",
                    "LATE_PAYMENT",
                ),
                block("var", "AMT_PAYMENT_TOTAL_CURRENT"),
            ),
        ),
        Segment(
            "CC_LAST_",
            (block("mean", "AMT_BALANCE"), block("max", "AMT_BALANCE")),
            rows="MONTHS_BALANCE = LAST_MONTH",
        ),
        _active_within(12),
        _active_within(24),
        _active_within(48),
    ),
)
COLUMNS = SPEC.names()


def row_features(cards: DataFrame) -> DataFrame:
    return cards.withColumnRenamed("AMT_RECIVABLE", "AMT_RECEIVABLE").withColumns(
        {
            **one_hot("NAME_CONTRACT_STATUS", CARD_CONTRACT_STATUS, null_as_zero=False),
            "LIMIT_USE": safe_ratio("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"),
            "PAYMENT_DIV_MIN": safe_ratio("AMT_PAYMENT_CURRENT", "AMT_INST_MIN_REGULARITY"),
            "LATE_PAYMENT": indicator(F.col("SK_DPD") > 0),
            "DRAWING_LIMIT_RATIO": safe_ratio(
                "AMT_DRAWINGS_ATM_CURRENT", "AMT_CREDIT_LIMIT_ACTUAL"
            ),
        }
    )


def features(cards: DataFrame) -> DataFrame:
    """One row per client.

    The last month of a card answers both questions asked of it: which rows are its latest, and
    whether it was active in a trailing period. So one join serves four segments.
    """
    rows = row_features(cards.where("SK_ID_CURR IS NOT NULL"))
    last_month = group_table(cards, ["SK_ID_PREV"], {"LAST_MONTH": F.max("MONTHS_BALANCE")})
    return build_features(rows.join(last_month, "SK_ID_PREV", "left"), SPEC)
