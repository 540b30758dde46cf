"""Previous applications of a client, with the payments made on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.scalar import (
    difference,
    one_hot,
    safe_ratio,
    simple_interest,
    without_sentinel,
)
from creditloom.functions.vocabulary import DAYS_SENTINEL, PREVIOUS_APPLICATION
from creditloom.operators.grouped import HOT_GROUP_ROWS
from creditloom.operators.relational import group_table
from creditloom.operators.spec import FeatureSpec, Segment, Vocabulary, block, build_features, quoted

SENTINEL_COLUMNS = (
    "DAYS_FIRST_DRAWING",
    "DAYS_FIRST_DUE",
    "DAYS_LAST_DUE_1ST_VERSION",
    "DAYS_LAST_DUE",
    "DAYS_TERMINATION",
)
#: Day columns as they are before the sentinel is removed.
AS_RECORDED = {c: f"RECORDED_{c}" for c in (*SENTINEL_COLUMNS, "DAYS_LAST_DUE_DIFF")}

_CONTRACT_SHARES = (
    "NAME_CONTRACT_TYPE_Consumer loans",
    "NAME_CONTRACT_TYPE_Cash loans",
    "NAME_CONTRACT_TYPE_Revolving loans",
)


def _by_contract(prefix: str, contract_type: str) -> Segment:
    return Segment(
        prefix,
        (
            block("var", "SIMPLE_INTERESTS", "APPLICATION_CREDIT_DIFF"),
            block(
                "max",
                "AMT_ANNUITY",
                "SIMPLE_INTERESTS",
                "APPLICATION_CREDIT_RATIO",
                "DAYS_DECISION",
                "DAYS_LAST_DUE_1ST_VERSION",
            ),
            block("min", "SIMPLE_INTERESTS", "APPLICATION_CREDIT_DIFF", "APPLICATION_CREDIT_RATIO"),
            block("sum", "AMT_CREDIT"),
            block(
                "mean",
                "AMT_ANNUITY",
                "SIMPLE_INTERESTS",
                "APPLICATION_CREDIT_RATIO",
                "DAYS_LAST_DUE_1ST_VERSION",
                "CNT_PAYMENT",
            ),
        ),
        rows=f"NAME_CONTRACT_TYPE = '{contract_type}'",
    )


def _recent(prefix: str, days: int) -> Segment:
    return Segment(
        prefix,
        (
            block(
                "mean",
                "AMT_ANNUITY",
                "SIMPLE_INTERESTS",
                "DAYS_DECISION",
                "DAYS_LAST_DUE_1ST_VERSION",
                "APPLICATION_CREDIT_RATIO",
                *_CONTRACT_SHARES,
            ),
            block(
                "min",
                "DAYS_DECISION",
                "DAYS_LAST_DUE_1ST_VERSION",
                "APPLICATION_CREDIT_DIFF",
                "APPLICATION_CREDIT_RATIO",
            ),
            block(
                "max",
                "AMT_ANNUITY",
                "SIMPLE_INTERESTS",
                "DAYS_LAST_DUE_1ST_VERSION",
                "APPLICATION_CREDIT_RATIO",
            ),
            block("sum", "AMT_CREDIT"),
        ),
        rows=f"DAYS_DECISION >= -{days}",
    )


_FLAGS = tuple(
    f"{column}_{category}"
    for column, categories in PREVIOUS_APPLICATION.items()
    for category in categories
)


# The names and the order of the published columns.
def build_spec(*, approved_as_recorded: bool = True) -> FeatureSpec:
    """The feature spec.

    ``approved_as_recorded`` keeps the sentinel day in the approved and active segments, as the
    published features do; switch it off to clean the days there too.
    """
    recorded = AS_RECORDED if approved_as_recorded else {}
    everything = Segment(
        "PREV_",
        (
            block(
                "max",
                "AMT_ANNUITY",
                "AMT_DOWN_PAYMENT",
                "HOUR_APPR_PROCESS_START",
                "RATE_DOWN_PAYMENT",
                "DAYS_DECISION",
                "CNT_PAYMENT",
                "DAYS_TERMINATION",
                "CREDIT_TO_ANNUITY_RATIO",
                "APPLICATION_CREDIT_DIFF",
                "APPLICATION_CREDIT_RATIO",
            ),
            block(
                "mean",
                *_FLAGS,
                "AMT_ANNUITY",
                "AMT_DOWN_PAYMENT",
                "HOUR_APPR_PROCESS_START",
                "RATE_DOWN_PAYMENT",
                "DAYS_DECISION",
                "CNT_PAYMENT",
                "CREDIT_TO_ANNUITY_RATIO",
                "APPLICATION_CREDIT_DIFF",
                "APPLICATION_CREDIT_RATIO",
                "DOWN_PAYMENT_TO_CREDIT",
            ),
            block(
                "min",
                "AMT_ANNUITY",
                "HOUR_APPR_PROCESS_START",
                "DAYS_DECISION",
                "APPLICATION_CREDIT_DIFF",
                "APPLICATION_CREDIT_RATIO",
            ),
            block("var", "APPLICATION_CREDIT_RATIO"),
            block("nunique", "SK_ID_PREV"),
        ),
    )
    active = Segment(
        "PREV_ACTIVE_",
        (
            block(
                "max",
                "AMT_ANNUITY",
                "AMT_APPLICATION",
                "AMT_DOWN_PAYMENT",
                "DAYS_LAST_DUE_1ST_VERSION",
                "INSTALMENT_PAYMENT_DIFF",
                "REMAINING_DEBT",
            ),
            block(
                "mean",
                "SIMPLE_INTERESTS",
                "AMT_APPLICATION",
                "AMT_DOWN_PAYMENT",
                "DAYS_DECISION",
                "CNT_PAYMENT",
                "DAYS_LAST_DUE_1ST_VERSION",
                "INSTALMENT_PAYMENT_DIFF",
                "REMAINING_DEBT",
                "REPAYMENT_RATIO",
            ),
            block("sum", "AMT_ANNUITY", "AMT_CREDIT", "CNT_PAYMENT", "REMAINING_DEBT", "AMT_PAYMENT"),
            block("min", "DAYS_DECISION", "DAYS_LAST_DUE_1ST_VERSION"),
            block("nunique", "SK_ID_PREV"),
        ),
        rows=(
            "NAME_CONTRACT_STATUS = 'Approved' AND "
            f"{AS_RECORDED['DAYS_LAST_DUE']} = {DAYS_SENTINEL}"
        ),
        reads=recorded,
    )
    approved = Segment(
        "APPROVED_",
        (
            block(
                "max",
                "AMT_ANNUITY",
                "AMT_CREDIT",
                "AMT_DOWN_PAYMENT",
                "AMT_GOODS_PRICE",
                "HOUR_APPR_PROCESS_START",
                "CNT_PAYMENT",
                "CREDIT_TO_ANNUITY_RATIO",
                "APPLICATION_CREDIT_DIFF",
                "APPLICATION_CREDIT_RATIO",
                "DAYS_FIRST_DRAWING",
                "DAYS_LAST_DUE_1ST_VERSION",
                "DAYS_LAST_DUE",
                "DAYS_LAST_DUE_DIFF",
                "SIMPLE_INTERESTS",
            ),
            block(
                "mean",
                "AMT_ANNUITY",
                "AMT_CREDIT",
                "DAYS_DECISION",
                "CNT_PAYMENT",
                "DAYS_TERMINATION",
                "CREDIT_TO_ANNUITY_RATIO",
                "APPLICATION_CREDIT_RATIO",
                "DAYS_FIRST_DRAWING",
                "DAYS_FIRST_DUE",
                "DAYS_LAST_DUE_1ST_VERSION",
                "DAYS_LAST_DUE",
                "DAYS_LAST_DUE_DIFF",
                "SIMPLE_INTERESTS",
            ),
            block(
                "min",
                "AMT_ANNUITY",
                "AMT_CREDIT",
                "HOUR_APPR_PROCESS_START",
                "DAYS_DECISION",
                "APPLICATION_CREDIT_RATIO",
                "DAYS_FIRST_DUE",
                "DAYS_LAST_DUE_1ST_VERSION",
                "DAYS_LAST_DUE_DIFF",
                "SIMPLE_INTERESTS",
            ),
            block("nunique", "SK_ID_PREV"),
        ),
        rows="NAME_CONTRACT_STATUS = 'Approved'",
        reads=recorded,
    )
    refused = Segment(
        "REFUSED_",
        (
            block("var", "APPLICATION_CREDIT_DIFF"),
            block(
                "max",
                "AMT_APPLICATION",
                "AMT_CREDIT",
                "DAYS_DECISION",
                "CNT_PAYMENT",
                "APPLICATION_CREDIT_DIFF",
            ),
            block(
                "min",
                "AMT_CREDIT",
                "DAYS_DECISION",
                "APPLICATION_CREDIT_DIFF",
                "APPLICATION_CREDIT_RATIO",
            ),
            block(
                "mean",
                "AMT_APPLICATION",
                "DAYS_DECISION",
                "CNT_PAYMENT",
                "APPLICATION_CREDIT_DIFF",
                "APPLICATION_CREDIT_RATIO",
                *_CONTRACT_SHARES,
            ),
        ),
        rows="NAME_CONTRACT_STATUS = 'Refused'",
    )
    late = Segment(
        "PREV_LATE_",
        (
            block("mean", "DAYS_DECISION", "DAYS_LAST_DUE_1ST_VERSION", *_CONTRACT_SHARES),
            block("min", "DAYS_DECISION", "DAYS_LAST_DUE_1ST_VERSION", "APPLICATION_CREDIT_DIFF"),
            block("max", "DAYS_DECISION", "DAYS_LAST_DUE_1ST_VERSION"),
        ),
        rows="PAID_LATE",
    )
    return FeatureSpec(
        keys=("SK_ID_CURR",),
        segments=(
            everything,
            active,
            approved,
            refused,
            _by_contract("PREV_Consumer_", "Consumer loans"),
            _by_contract("PREV_Cash_", "Cash loans"),
            late,
            _recent("PREV_LAST12M_", 360),
            _recent("PREV_LAST24M_", 720),
        ),
        vocabularies=tuple(
            Vocabulary(c, v, null_as_zero=False) for c, v in PREVIOUS_APPLICATION.items()
        ),
    )


SPEC = build_spec()
REPAID = "TOTAL_REPAYMENT_RATIO"


def _columns() -> list[str]:
    """Output order: the repayment ratio closes the block of the active loans."""
    names = SPEC.names()
    after = names.index("PREV_ACTIVE_SK_ID_PREV_NUNIQUE") + 1
    return [*names[:after], REPAID, *names[after:]]


COLUMNS = _columns()


def payments_per_loan(payments: DataFrame) -> DataFrame:
    """Per loan: amounts due and paid, and whether any payment came after its due day."""
    return group_table(
        payments.where("SK_ID_PREV IS NOT NULL"),
        ["SK_ID_PREV"],
        {
            "AMT_INSTALMENT": F.sum("AMT_INSTALMENT"),
            "AMT_PAYMENT": F.sum("AMT_PAYMENT"),
            "PAID_LATE": F.max(F.col("DAYS_ENTRY_PAYMENT") > F.col("DAYS_INSTALMENT")),
        },
    )


def row_features(previous: DataFrame) -> DataFrame:
    """Ratios, flags and cleaned day columns of every application."""
    flags = {
        name: flag
        for column, categories in PREVIOUS_APPLICATION.items()
        for name, flag in one_hot(column, categories, null_as_zero=False).items()
    }
    derived = {
        "APPLICATION_CREDIT_DIFF": difference("AMT_APPLICATION", "AMT_CREDIT"),
        "APPLICATION_CREDIT_RATIO": safe_ratio("AMT_APPLICATION", "AMT_CREDIT"),
        "CREDIT_TO_ANNUITY_RATIO": safe_ratio("AMT_CREDIT", "AMT_ANNUITY"),
        "DOWN_PAYMENT_TO_CREDIT": safe_ratio("AMT_DOWN_PAYMENT", "AMT_CREDIT"),
        "SIMPLE_INTERESTS": simple_interest("AMT_ANNUITY", "AMT_CREDIT", "CNT_PAYMENT"),
    }
    last_due_diff = difference("DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE")
    recorded = {AS_RECORDED[c]: F.col(c) for c in SENTINEL_COLUMNS}
    cleaned = {
        c: without_sentinel(F.col(c).cast("int"), DAYS_SENTINEL) for c in SENTINEL_COLUMNS
    }
    return (
        previous.withColumns({**flags, **derived, **recorded})
        .withColumn(AS_RECORDED["DAYS_LAST_DUE_DIFF"], last_due_diff)
        .withColumns(cleaned)
        .withColumn("DAYS_LAST_DUE_DIFF", last_due_diff)
    )


def loan_rows(previous: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per application with its own features and what its payments say."""
    return (
        row_features(previous)
        .join(payments_per_loan(payments), "SK_ID_PREV", "left")
        .withColumns(
            {
                "INSTALMENT_PAYMENT_DIFF": difference("AMT_INSTALMENT", "AMT_PAYMENT"),
                "REMAINING_DEBT": difference("AMT_CREDIT", "AMT_PAYMENT"),
                "REPAYMENT_RATIO": safe_ratio("AMT_PAYMENT", "AMT_CREDIT"),
            }
        )
    )


def features(
    previous: DataFrame,
    payments: DataFrame,
    *,
    approved_as_recorded: bool = True,
    hot_rows: int | None = HOT_GROUP_ROWS,
) -> DataFrame:
    """One row per client; ``hot_rows=None`` says that no client is hot, and spares a counting job."""
    spec = build_spec(approved_as_recorded=approved_as_recorded)
    rows = loan_rows(previous, payments)
    wide = build_features(rows, spec, members=previous, hot_rows=hot_rows)
    repaid = safe_ratio("PREV_ACTIVE_AMT_PAYMENT_SUM", "PREV_ACTIVE_AMT_CREDIT_SUM")
    return wide.withColumn(REPAID, repaid).select(*map(quoted, COLUMNS))
