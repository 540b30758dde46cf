"""Declared schemas of the credit tables, so that no read needs an inference pass."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_KINDS = {"id": LongType(), "int": IntegerType(), "num": DoubleType(), "text": StringType()}


def _schema(*groups: tuple[str, str]) -> StructType:
    """Build a schema from (kind, "NAME NAME ...") groups; every column is nullable."""
    return StructType(
        [StructField(name, _KINDS[kind], True) for kind, names in groups for name in names.split()]
    )


APPLICATION = _schema(
    ("id", "SK_ID_CURR"),
    ("text", "CODE_GENDER"),
    ("num", "AMT_INCOME_TOTAL AMT_CREDIT AMT_ANNUITY"),
    ("int", "DAYS_EMPLOYED DAYS_BIRTH"),
    ("num", "EXT_SOURCE_1 EXT_SOURCE_2 EXT_SOURCE_3"),
    ("text", "ORGANIZATION_TYPE NAME_EDUCATION_TYPE OCCUPATION_TYPE"),
)

APPLICATION_TRAIN = StructType(
    [APPLICATION.fields[0], StructField("TARGET", IntegerType(), True), *APPLICATION.fields[1:]]
)

BUREAU = _schema(
    ("id", "SK_ID_BUREAU SK_ID_CURR"),
    ("text", "CREDIT_ACTIVE CREDIT_CURRENCY CREDIT_TYPE"),
    ("int", "DAYS_CREDIT DAYS_CREDIT_UPDATE"),
    ("num", "DAYS_CREDIT_ENDDATE DAYS_ENDDATE_FACT"),
    ("num", "AMT_CREDIT_SUM AMT_CREDIT_SUM_DEBT AMT_CREDIT_SUM_OVERDUE AMT_CREDIT_MAX_OVERDUE"),
    ("num", "AMT_ANNUITY"),
)

BUREAU_BALANCE = _schema(("id", "SK_ID_BUREAU"), ("int", "MONTHS_BALANCE"), ("text", "STATUS"))

CREDIT_CARD_BALANCE = _schema(
    ("id", "SK_ID_PREV SK_ID_CURR"),
    ("int", "MONTHS_BALANCE SK_DPD SK_DPD_DEF"),
    ("text", "NAME_CONTRACT_STATUS"),
    ("num", "AMT_BALANCE AMT_CREDIT_LIMIT_ACTUAL AMT_RECIVABLE AMT_TOTAL_RECEIVABLE"),
    ("num", "AMT_PAYMENT_CURRENT AMT_PAYMENT_TOTAL_CURRENT AMT_INST_MIN_REGULARITY"),
    ("num", "AMT_DRAWINGS_ATM_CURRENT AMT_DRAWINGS_CURRENT AMT_DRAWINGS_POS_CURRENT"),
    ("num", "CNT_DRAWINGS_ATM_CURRENT CNT_DRAWINGS_CURRENT CNT_DRAWINGS_POS_CURRENT"),
)

POS_CASH_BALANCE = _schema(
    ("id", "SK_ID_PREV SK_ID_CURR"),
    ("int", "MONTHS_BALANCE SK_DPD SK_DPD_DEF"),
    ("num", "CNT_INSTALMENT CNT_INSTALMENT_FUTURE"),
    ("text", "NAME_CONTRACT_STATUS"),
)

INSTALLMENTS_PAYMENTS = _schema(
    ("id", "SK_ID_PREV SK_ID_CURR"),
    ("int", "NUM_INSTALMENT_NUMBER"),
    ("num", "DAYS_INSTALMENT DAYS_ENTRY_PAYMENT AMT_INSTALMENT AMT_PAYMENT"),
)

PREVIOUS_APPLICATION = _schema(
    ("id", "SK_ID_PREV SK_ID_CURR"),
    ("int", "DAYS_DECISION HOUR_APPR_PROCESS_START"),
    ("num", "AMT_APPLICATION AMT_CREDIT AMT_ANNUITY AMT_DOWN_PAYMENT AMT_GOODS_PRICE"),
    ("num", "RATE_DOWN_PAYMENT CNT_PAYMENT"),
    ("num", "DAYS_FIRST_DRAWING DAYS_FIRST_DUE DAYS_LAST_DUE_1ST_VERSION DAYS_LAST_DUE"),
    ("num", "DAYS_TERMINATION"),
    ("text", "NAME_CONTRACT_STATUS NAME_CONTRACT_TYPE CHANNEL_TYPE NAME_TYPE_SUITE"),
    ("text", "NAME_YIELD_GROUP PRODUCT_COMBINATION NAME_PRODUCT_TYPE NAME_CLIENT_TYPE"),
)

SUBMISSION_STREAM = _schema(("text", "key value"))

TABLES: dict[str, StructType] = {
    "application_train": APPLICATION_TRAIN,
    "application_test": APPLICATION,
    "bureau": BUREAU,
    "bureau_balance": BUREAU_BALANCE,
    "credit_card_balance": CREDIT_CARD_BALANCE,
    "pos_cash_balance": POS_CASH_BALANCE,
    "installments_payments": INSTALLMENTS_PAYMENTS,
    "previous_application": PREVIOUS_APPLICATION,
}
