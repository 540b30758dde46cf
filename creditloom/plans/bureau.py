"""Credit bureau: loans reported by other lenders, with their monthly balance history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.scalar import difference, one_hot, row_sum, safe_ratio
from creditloom.functions.vocabulary import BUREAU, MONTHLY_STATUS
from creditloom.operators.grouped import HOT_GROUP_ROWS, latest_value
from creditloom.operators.relational import group_table, with_peer_means
from creditloom.operators.spec import FeatureSpec, Segment, Vocabulary, block, build_features, quoted
from creditloom.session import written


PEER_COLUMNS = (
    "AMT_CREDIT_MAX_OVERDUE",
    "AMT_CREDIT_SUM_OVERDUE",
    "AMT_CREDIT_SUM",
    "AMT_CREDIT_SUM_DEBT",
    "DEBT_PERCENTAGE",
    "DEBT_CREDIT_DIFF",
    "STATUS_0",
    "STATUS_12345",
)


def _by_type(prefix: str, credit_type: str) -> Segment:
    return Segment(
        prefix,
        (
            block(
                "mean",
                "DAYS_CREDIT",
                "AMT_CREDIT_MAX_OVERDUE",
                "AMT_CREDIT_SUM",
                "AMT_CREDIT_SUM_DEBT",
                "DEBT_PERCENTAGE",
                "DEBT_CREDIT_DIFF",
            ),
            block(
                "max",
                "DAYS_CREDIT",
                "AMT_CREDIT_MAX_OVERDUE",
                "AMT_CREDIT_SUM",
                "AMT_CREDIT_SUM_DEBT",
                "DAYS_CREDIT_ENDDATE",
            ),
        ),
        rows=f"CREDIT_TYPE = '{credit_type}'",
    )


def _recent(prefix: str, days: int) -> Segment:
    return Segment(
        prefix,
        (
            block(
                "mean",
                "AMT_CREDIT_MAX_OVERDUE",
                "AMT_CREDIT_SUM_OVERDUE",
                "AMT_CREDIT_SUM_DEBT",
                "DEBT_PERCENTAGE",
                "DEBT_CREDIT_DIFF",
                "STATUS_0",
                "STATUS_12345",
            ),
            block("max", "AMT_CREDIT_MAX_OVERDUE", "AMT_CREDIT_SUM"),
            block("sum", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT"),
        ),
        rows=f"DAYS_CREDIT >= -{days}",
    )


# The names and the order of the published columns.
SPEC = FeatureSpec(
    keys=("SK_ID_CURR",),
    segments=(
        Segment(
            "BUREAU_",
            (
                block(
                    "mean",
                    "DAYS_CREDIT",
                    "AMT_CREDIT_MAX_OVERDUE",
                    "AMT_CREDIT_SUM",
                    "AMT_CREDIT_SUM_DEBT",
                    "AMT_CREDIT_SUM_OVERDUE",
                    "AMT_ANNUITY",
                    "DEBT_CREDIT_DIFF",
                    "MONTHS_BALANCE_MEAN",
                    "MONTHS_BALANCE_SIZE",
                    "STATUS_0",
                    "STATUS_1",
                    "STATUS_12345",
                    "STATUS_C",
                    "STATUS_X",
                    "CREDIT_ACTIVE_Active",
                    "CREDIT_ACTIVE_Closed",
                    "CREDIT_ACTIVE_Sold",
                    "CREDIT_TYPE_Consumer credit",
                    "CREDIT_TYPE_Credit card",
                    "CREDIT_TYPE_Car loan",
                    "CREDIT_TYPE_Mortgage",
                    "CREDIT_TYPE_Microloan",
                    "LL_AMT_CREDIT_SUM_OVERDUE",
                    "LL_DEBT_CREDIT_DIFF",
                    "LL_STATUS_12345",
                ),
                block(
                    "sum",
                    "AMT_CREDIT_SUM",
                    "AMT_CREDIT_SUM_DEBT",
                    "AMT_CREDIT_SUM_OVERDUE",
                    "DEBT_CREDIT_DIFF",
                    "MONTHS_BALANCE_SIZE",
                ),
                block("nunique", "SK_ID_BUREAU"),
                block(
                    "max",
                    "DAYS_CREDIT",
                    "DAYS_CREDIT_ENDDATE",
                    "AMT_CREDIT_MAX_OVERDUE",
                    "AMT_CREDIT_SUM",
                    "AMT_CREDIT_SUM_DEBT",
                    "AMT_CREDIT_SUM_OVERDUE",
                ),
                block("min", "DAYS_CREDIT", "DAYS_CREDIT_ENDDATE"),
                block("var", "MONTHS_BALANCE_MEAN"),
            ),
        ),
        Segment(
            "BUREAU_ACTIVE_",
            (
                block(
                    "mean",
                    "DAYS_CREDIT",
                    "AMT_CREDIT_MAX_OVERDUE",
                    "AMT_CREDIT_SUM_DEBT",
                    "AMT_CREDIT_SUM_OVERDUE",
                    "DAYS_CREDIT_UPDATE",
                    "DEBT_PERCENTAGE",
                    "DEBT_CREDIT_DIFF",
                    "CREDIT_TO_ANNUITY_RATIO",
                    "MONTHS_BALANCE_MEAN",
                    "MONTHS_BALANCE_SIZE",
                ),
                block(
                    "max",
                    "DAYS_CREDIT",
                    "DAYS_CREDIT_ENDDATE",
                    "AMT_CREDIT_MAX_OVERDUE",
                    "AMT_CREDIT_SUM",
                    "AMT_CREDIT_SUM_OVERDUE",
                ),
                block("min", "DAYS_CREDIT_ENDDATE", "DAYS_CREDIT_UPDATE"),
                block("sum", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "MONTHS_BALANCE_SIZE"),
                block("var", "MONTHS_BALANCE_MEAN"),
            ),
            rows="CREDIT_ACTIVE = 'Active'",
        ),
        Segment(
            "BUREAU_CLOSED_",
            (
                block(
                    "mean",
                    "AMT_CREDIT_MAX_OVERDUE",
                    "AMT_CREDIT_SUM_OVERDUE",
                    "AMT_CREDIT_SUM",
                    "ENDDATE_DIF",
                    "STATUS_12345",
                ),
                block(
                    "max",
                    "DAYS_CREDIT",
                    "DAYS_CREDIT_ENDDATE",
                    "AMT_CREDIT_MAX_OVERDUE",
                    "AMT_CREDIT_SUM",
                    "AMT_CREDIT_SUM_DEBT",
                    "DAYS_CREDIT_UPDATE",
                ),
                block("sum", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT"),
                block("var", "DAYS_CREDIT"),
            ),
            rows="CREDIT_ACTIVE = 'Closed'",
        ),
        _by_type("BUREAU_CONSUMER_", "Consumer credit"),
        _by_type("BUREAU_CREDIT_", "Credit card"),
        _by_type("BUREAU_MORTGAGE_", "Mortgage"),
        _by_type("BUREAU_CAR_", "Car loan"),
        _by_type("BUREAU_MICROLOAN_", "Microloan"),
        _recent("BUREAU_LAST6M_", 180),
        _recent("BUREAU_LAST12M_", 360),
    ),
    vocabularies=tuple(Vocabulary(c, v, null_as_zero=True) for c, v in BUREAU.items()),
)

LATEST = "BUREAU_LAST_LOAN_MAX_OVERDUE"
#: Output column -> (numerator, divisor), both output columns.
RATIOS = {
    "BUREAU_DEBT_OVER_CREDIT": ("BUREAU_AMT_CREDIT_SUM_DEBT_SUM", "BUREAU_AMT_CREDIT_SUM_SUM"),
    "BUREAU_ACTIVE_DEBT_OVER_CREDIT": (
        "BUREAU_ACTIVE_AMT_CREDIT_SUM_DEBT_SUM",
        "BUREAU_ACTIVE_AMT_CREDIT_SUM_SUM",
    ),
}
COLUMNS = [*SPEC.names(), LATEST, *RATIOS]


def balance_history(balance: DataFrame) -> DataFrame:
    """Per loan: share of months in each status, and the extent of the history."""
    status = one_hot("STATUS", MONTHLY_STATUS, null_as_zero=True)
    return group_table(
        balance.where("SK_ID_BUREAU IS NOT NULL"),
        ["SK_ID_BUREAU"],
        {
            **{name: F.avg(flag) for name, flag in status.items()},
            "MONTHS_BALANCE_MIN": F.min("MONTHS_BALANCE"),
            "MONTHS_BALANCE_MAX": F.max("MONTHS_BALANCE"),
            "MONTHS_BALANCE_MEAN": F.avg("MONTHS_BALANCE"),
            "MONTHS_BALANCE_SIZE": F.count("MONTHS_BALANCE"),
        },
    )


def row_features(loans: DataFrame) -> DataFrame:
    flags = {
        name: flag
        for column, categories in BUREAU.items()
        if column in loans.columns
        for name, flag in one_hot(column, categories, null_as_zero=True).items()
    }
    return loans.withColumns(
        {
            "CREDIT_DURATION": difference("DAYS_CREDIT_ENDDATE", "DAYS_CREDIT"),
            "ENDDATE_DIF": difference("DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT"),
            "DEBT_PERCENTAGE": safe_ratio("AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT"),
            "DEBT_CREDIT_DIFF": difference("AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT"),
            "CREDIT_TO_ANNUITY_RATIO": safe_ratio("AMT_CREDIT_SUM", "AMT_ANNUITY"),
            **flags,
        }
    )


#: Columns of a loan and of its history that the features are made of.
INPUTS = (
    "SK_ID_BUREAU",
    "SK_ID_CURR",
    "CREDIT_ACTIVE",
    "CREDIT_TYPE",
    "DAYS_CREDIT",
    "DAYS_CREDIT_UPDATE",
    "DAYS_CREDIT_ENDDATE",
    "DAYS_ENDDATE_FACT",
    "AMT_CREDIT_SUM",
    "AMT_CREDIT_SUM_DEBT",
    "AMT_CREDIT_SUM_OVERDUE",
    "AMT_CREDIT_MAX_OVERDUE",
    "AMT_ANNUITY",
    "MONTHS_BALANCE_MEAN",
    "MONTHS_BALANCE_SIZE",
    *(f"STATUS_{status}" for status in MONTHLY_STATUS),
)


def loan_rows(
    bureau: DataFrame,
    balance: DataFrame,
    *,
    inputs: Sequence[str] | None = None,
    peers: Sequence[str] = PEER_COLUMNS,
) -> DataFrame:
    """One row per bureau loan with its own, its history's and its peers' features.

    The loans with their history are read twice - for the peer means and for the features - so
    they are joined once and written, all columns or the ``inputs`` that are needed.
    """
    joined = bureau.join(balance_history(balance), "SK_ID_BUREAU", "left")
    rows = row_features(written(joined.select(*(inputs or joined.columns)))).withColumn(
        "STATUS_12345", row_sum([f"STATUS_{i}" for i in range(1, 6)])
    )
    return with_peer_means(rows, "MONTHS_BALANCE_SIZE", peers, "LL_", stored=True)


def features(
    bureau: DataFrame, balance: DataFrame, *, hot_rows: int | None = HOT_GROUP_ROWS
) -> DataFrame:
    """One row per client. Loans without an id are left out: they cannot be told apart.

    ``hot_rows=None`` says that no client is hot, and spares a counting job.
    """
    bureau = bureau.where("SK_ID_BUREAU IS NOT NULL")
    used = {feature.column for feature in SPEC.features()}
    peers = [c for c in PEER_COLUMNS if f"LL_{c}" in used]
    rows = loan_rows(bureau, balance, inputs=INPUTS, peers=peers)
    wide = build_features(rows, SPEC, members=bureau, hot_rows=hot_rows)
    latest = latest_value(
        bureau.where("SK_ID_CURR IS NOT NULL"),
        "SK_ID_CURR",
        "AMT_CREDIT_MAX_OVERDUE",
        ["DAYS_CREDIT", "SK_ID_BUREAU"],
        LATEST,
    )
    ratios = {name: safe_ratio(*pair) for name, pair in RATIOS.items()}
    return (
        wide.join(latest, "SK_ID_CURR", "left")
        .withColumns(ratios)
        .select(*map(quoted, COLUMNS))
    )
