"""Point-of-sale and cash loans: monthly balance rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.scalar import indicator, one_hot, safe_ratio, truthy
from creditloom.functions.vocabulary import POS_CONTRACT_STATUS
from creditloom.operators.grouped import top_k_mean
from creditloom.operators.spec import FeatureSpec, Segment, Vocabulary, block, build_features, quoted

# The names and the order of the published columns.
SPEC = FeatureSpec(
    keys=("SK_ID_CURR",),
    segments=(
        Segment(
            "POS_",
            (
                block(
                    "mean",
                    "NAME_CONTRACT_STATUS_Active",
                    "NAME_CONTRACT_STATUS_Approved",
                    "NAME_CONTRACT_STATUS_Completed",
                    "NAME_CONTRACT_STATUS_Demand",
                    "NAME_CONTRACT_STATUS_Returned to the store",
                    "NAME_CONTRACT_STATUS_Signed",
                    "SK_DPD",
                    "SK_DPD_DEF",
                    "LATE_PAYMENT",
                ),
                block("min", "MONTHS_BALANCE"),
                block("max", "MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF"),
                block("nunique", "SK_ID_PREV"),
                block("size", "MONTHS_BALANCE"),
                block("var", "SK_DPD"),
                block("sum", "SK_DPD_DEF", "SK_DPD"),
            ),
        ),
    ),
    vocabularies=(Vocabulary("NAME_CONTRACT_STATUS", POS_CONTRACT_STATUS, null_as_zero=False),),
)
#: Sums over the loans of a client.
LOAN_SUMS = (
    "POS_LOAN_COMPLETED_MEAN",
    "POS_REMAINING_INSTALMENTS",
    "POS_COMPLETED_BEFORE_MEAN",
    "POS_REMAINING_INSTALMENTS_RATIO",
)
LATE = "LATE_PAYMENT_SUM"
COLUMNS = [*SPEC.names(), *LOAN_SUMS, LATE]


def row_features(balance: DataFrame) -> DataFrame:
    return balance.withColumns(
        {
            **one_hot("NAME_CONTRACT_STATUS", POS_CONTRACT_STATUS, null_as_zero=False),
            "LATE_PAYMENT": truthy("SK_DPD"),
        }
    )


def loan_features(rows: DataFrame) -> DataFrame:
    """One row per loan: completion, remaining instalments, late months.

    The struct orderings carry the picked columns, so tied months give one definite answer.
    """
    first = F.min(F.struct("MONTHS_BALANCE", "SK_ID_CURR", "CNT_INSTALMENT"))
    last = F.max(F.struct("MONTHS_BALANCE", "SK_ID_CURR", "CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE"))
    loans = rows.groupBy("SK_ID_PREV").agg(
        first.alias("first"),
        last.alias("last"),
        F.avg("NAME_CONTRACT_STATUS_Completed").alias("POS_LOAN_COMPLETED_MEAN"),
        F.sum("LATE_PAYMENT").alias("late_months"),
    )
    shortened = F.col("first.CNT_INSTALMENT") - F.col("last.CNT_INSTALMENT") > 0
    has_latest_row = F.col("SK_ID_PREV").isNotNull() & F.col("last.MONTHS_BALANCE").isNotNull()
    return loans.select(
        F.col("first.SK_ID_CURR").alias("SK_ID_CURR"),
        F.col("last.SK_ID_CURR").alias("LATEST_CLIENT"),
        "POS_LOAN_COMPLETED_MEAN",
        F.col("last.CNT_INSTALMENT_FUTURE").alias("POS_REMAINING_INSTALMENTS"),
        indicator((F.col("POS_LOAN_COMPLETED_MEAN") > 0) & shortened).alias(
            "POS_COMPLETED_BEFORE_MEAN"
        ),
        safe_ratio(F.col("last.CNT_INSTALMENT_FUTURE"), F.col("last.CNT_INSTALMENT")).alias(
            "POS_REMAINING_INSTALMENTS_RATIO"
        ),
        has_latest_row.alias("HAS_LATEST_ROW"),
        F.col("late_months").cast("double").alias("LATE_MONTHS"),
    )


def features(balance: DataFrame, *, late_of_top: int = 1) -> DataFrame:
    """One row per client.

    ``late_of_top`` says over how many of the client's worst loans the late months are averaged;
    the published feature is the single worst loan.
    """
    rows = row_features(balance)
    loans = loan_features(rows)
    per_client = loans.groupBy("SK_ID_CURR").agg(*(F.sum(c).alias(c) for c in LOAN_SUMS))
    # late months belong to the client of the loan's latest row
    latest = loans.where("HAS_LATEST_ROW").select(
        F.col("LATEST_CLIENT").alias("SK_ID_CURR"), "LATE_MONTHS"
    )
    if late_of_top == 1:
        late = latest.groupBy("SK_ID_CURR").agg(
            F.coalesce(F.max("LATE_MONTHS"), F.lit(0.0)).alias(LATE)
        )
    else:
        late = top_k_mean(latest, ["SK_ID_CURR"], "LATE_MONTHS", LATE, late_of_top)
    return (
        build_features(rows, SPEC)
        .join(per_client, "SK_ID_CURR", "left")
        .join(late, "SK_ID_CURR", "left")
        .select(*map(quoted, COLUMNS))
    )
