"""Instalment payments: one row per payment of an instalment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.scalar import difference, indicator, safe_ratio
from creditloom.operators.grouped import HOT_GROUP_ROWS
from creditloom.operators.relational import with_group_total
from creditloom.operators.spec import FeatureSpec, Segment, block, build_features
from creditloom.sources.copartitioned import Stored

_PERIOD_MEANS = (
    "DAYS_ENTRY_PAYMENT",
    "AMT_INSTALMENT",
    "AMT_PAYMENT",
    "DPD",
    "DBD",
    "PAYMENT_DIFFERENCE",
    "PAYMENT_RATIO",
    "LATE_PAYMENT",
    "SIGNIFICANT_LATE_PAYMENT",
    "LATE_PAYMENT_RATIO",
    "DPD_7",
    "DPD_15",
)
_EXTREMES = ("DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT")


def _single_loan_within(months: int) -> Segment:
    """All rows of the clients with exactly one loan due in the last months (of 30 days).

    Whether a client qualifies is an aggregate of the same group, so the segment reuses the
    aggregates of the whole table: nothing is joined and nothing is aggregated twice.
    """
    recent = f"CASE WHEN DAYS_INSTALMENT >= -{30 * months} THEN SK_ID_PREV END"
    return Segment(
        f"INS_{months}M_",
        (
            block("max", *_EXTREMES, "DPD", "DBD"),
            block("mean", *_PERIOD_MEANS),
            block("min", *_EXTREMES),
            block("sum", "AMT_INSTALMENT", "AMT_PAYMENT"),
            block("size", "SK_ID_PREV"),
            block("var", "DPD", "DBD"),
        ),
        group=f"min({recent}) = max({recent})",
    )


# The names and the order of the published columns.
SPEC = FeatureSpec(
    keys=("SK_ID_CURR",),
    segments=(
        Segment(
            "INS_",
            (
                block("mean", *_PERIOD_MEANS, "PAID_OVER"),
                block("max", *_EXTREMES, "DPD", "DBD"),
                block("var", "DPD", "DBD"),
                block("min", *_EXTREMES),
                block(
                    "sum",
                    "AMT_INSTALMENT",
                    "AMT_PAYMENT",
                    "LATE_PAYMENT",
                    "SIGNIFICANT_LATE_PAYMENT",
                ),
                block("size", "SK_ID_PREV"),
                block("nunique", "SK_ID_PREV"),
            ),
        ),
        _single_loan_within(36),
        _single_loan_within(60),
    ),
)
COLUMNS = SPEC.names()


def row_features(payments: DataFrame) -> DataFrame:
    """Payment features of every row.

    ``DPD`` and ``DBD`` are 0/1 flags (paid after / before the due day) and ``LATE_PAYMENT``
    follows ``DBD``; the published features are defined this way and keep their names.
    """
    return paid_features(
        with_group_total(
            payments,
            ["SK_ID_PREV", "NUM_INSTALMENT_NUMBER"],
            {"AMT_PAYMENT_GROUPED": F.sum("AMT_PAYMENT")},
        )
    )


def paid_features(paid: DataFrame) -> DataFrame:
    """The features of payments that have the sum of their instalment, ``AMT_PAYMENT_GROUPED``."""
    share = safe_ratio("AMT_PAYMENT", "AMT_INSTALMENT")
    paid_on, due_on = F.col("DAYS_ENTRY_PAYMENT"), F.col("DAYS_INSTALMENT")
    after, before = indicator(paid_on > due_on), indicator(paid_on < due_on)
    weighed = share * before
    return paid.withColumns(
        {
            "PAYMENT_DIFFERENCE": difference("AMT_INSTALMENT", "AMT_PAYMENT_GROUPED"),
            "PAYMENT_RATIO": safe_ratio("AMT_INSTALMENT", "AMT_PAYMENT_GROUPED"),
            "PAID_OVER": indicator(share > 0),
            "DPD": after,
            "DPD_7": indicator(after >= 7),
            "DPD_15": indicator(after >= 15),
            "DBD": before,
            "LATE_PAYMENT": before,
            "LATE_PAYMENT_RATIO": weighed,
            "SIGNIFICANT_LATE_PAYMENT": indicator(weighed > 0.05),
        }
    )


def features(payments: DataFrame, *, hot_rows: int | None = HOT_GROUP_ROWS) -> DataFrame:
    """One row per client; ``hot_rows=None`` says that no client is hot, and spares a counting job."""
    return build_features(row_features(payments), SPEC, hot_rows=hot_rows)


def _of_buckets(payments: DataFrame) -> DataFrame:
    """Features of payments that lie together by client: sums, counts and groups stay in place."""
    keys = ["SK_ID_CURR", "SK_ID_PREV", "NUM_INSTALMENT_NUMBER"]
    known = F.col("SK_ID_PREV").isNotNull() & F.col("NUM_INSTALMENT_NUMBER").isNotNull()
    total = F.sum("AMT_PAYMENT").over(Window.partitionBy(*keys))
    paid = payments.withColumn("AMT_PAYMENT_GROUPED", F.when(known, total))
    return build_features(paid_features(paid), SPEC, cluster_from=None)


def stored_features(payments: Stored) -> DataFrame:
    """:func:`features` of payments stored by client, without a shuffle of the ordinary clients.

    The payments of an instalment have to be of one client.
    """
    return payments.derive(_of_buckets, lambda hot: build_features(row_features(hot), SPEC, cluster_from=None))
