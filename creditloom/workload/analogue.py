"""Credit tables made from the shared test tables.

Every credit column is a SQL expression over customers, orders and order lines. The same text runs
in Spark and in the checking engine; only day and month offsets are spelled differently. Amounts
are whole numbers (cents), so that sums and means do not depend on the order of summation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from creditloom.functions.vocabulary import DAYS_SENTINEL, POS_CONTRACT_STATUS, PREVIOUS_APPLICATION
from creditloom.workload.registry import REFERENCE_DATE, Tables, days_sql, months_sql


@dataclass(frozen=True)
class Offsets:
    """How a dialect writes the day and the month offset of a date column."""

    spark: bool

    def days(self, column: str) -> str:
        if self.spark:
            return f"datediff(CAST({column} AS DATE), DATE '{REFERENCE_DATE}')"
        return days_sql(column)

    def months(self, column: str) -> str:
        if self.spark:
            return f"((year({column}) - 2001) * 12 + month({column}) - 12)"
        return months_sql(column)


SPARK, CHECK = Offsets(True), Offsets(False)


def _choice(selector: str, values: tuple[str, ...]) -> str:
    """One of the values by a whole-number selector; NULL for one remainder."""
    arms = " ".join(f"WHEN {i} THEN '{value}'" for i, value in enumerate(values))
    return f"CASE ({selector}) % {len(values) + 1} {arms} END"


_CLIENT = "CASE WHEN o_custkey % 97 <> 13 THEN o_custkey END"
_PRICE = "round(o_totalprice * 100)"
_LINE_PRICE = "round(l_extendedprice * 100)"

#: Table -> the relation its columns are computed from, in names both engines know.
RELATIONS = {
    "application": "customer",
    "bureau": "orders",
    "bureau_balance": "lineitem",
    "credit_card_balance": "lineitem JOIN orders ON l_orderkey = o_orderkey",
    "pos_cash_balance": "lineitem JOIN orders ON l_orderkey = o_orderkey",
    "installments_payments": "lineitem JOIN orders ON l_orderkey = o_orderkey",
    "previous_application": "orders",
}


def _application(_: Offsets) -> dict[str, str]:
    def score(remainder: int, modulus: int) -> str:
        return f"CASE WHEN c_custkey % {modulus} <> {remainder} THEN c_custkey % 101 / 128e0 END"

    return {
        "SK_ID_CURR": "c_custkey",
        "CODE_GENDER": "CASE c_custkey % 10 WHEN 0 THEN 'XNA' WHEN 1 THEN NULL WHEN 2 THEN 'F' "
        "WHEN 4 THEN 'F' WHEN 6 THEN 'F' ELSE 'M' END",
        "AMT_INCOME_TOTAL": "round(c_acctbal * 100) * 30",
        "AMT_CREDIT": "CASE WHEN c_custkey % 17 <> 0 THEN round(c_acctbal * 100) + 200000 END",
        "AMT_ANNUITY": "CAST(c_custkey % 9 * 1000 AS DOUBLE)",
        "DAYS_EMPLOYED": "CASE WHEN c_custkey % 5 <> 0 THEN CAST(-c_custkey % 9000 AS INTEGER) END",
        "DAYS_BIRTH": "CAST(-(7000 + c_custkey * 37 % 25000) AS INTEGER)",
        "EXT_SOURCE_1": score(0, 4),
        "EXT_SOURCE_2": score(1, 6),
        "EXT_SOURCE_3": score(0, 8),
        "ORGANIZATION_TYPE": "c_mktsegment",
        "NAME_EDUCATION_TYPE": "CASE c_nationkey % 3 WHEN 0 THEN 'Higher' ELSE 'Secondary' END",
        "OCCUPATION_TYPE": "CASE c_nationkey % 5 WHEN 4 THEN NULL WHEN 3 THEN 'Driver' "
        "ELSE 'Clerk' END",
    }


def _bureau(d: Offsets) -> dict[str, str]:
    return {
        # loans without an id, which do not count
        "SK_ID_BUREAU": "CASE WHEN o_orderkey % 41 <> 7 THEN o_orderkey END",
        "SK_ID_CURR": _CLIENT,
        "CREDIT_ACTIVE": "CASE WHEN o_orderstatus = 'F' THEN 'Closed' "
        "WHEN o_orderstatus = 'O' THEN 'Active' WHEN o_orderkey % 3 = 0 THEN 'Sold' "
        "WHEN o_orderkey % 3 = 1 THEN 'Bad debt' END",
        "CREDIT_CURRENCY": "CASE o_orderkey % 5 WHEN 0 THEN 'currency 2' ELSE 'currency 1' END",
        "CREDIT_TYPE": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Consumer credit' "
        "WHEN o_orderpriority = '2-HIGH' THEN 'Credit card' "
        "WHEN o_orderpriority = '3-MEDIUM' THEN 'Mortgage' "
        "WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Car loan' "
        "WHEN o_orderkey % 2 = 0 THEN 'Microloan' ELSE 'Real estate loan' END",
        "DAYS_CREDIT": d.days("o_orderdate"),
        "DAYS_CREDIT_UPDATE": f"CAST({d.days('o_orderdate')} + o_orderkey % 60 AS INTEGER)",
        "DAYS_CREDIT_ENDDATE": "CASE WHEN o_orderkey % 11 <> 0 THEN "
        f"CAST({d.days('o_orderdate')} + 365 * (1 + o_orderkey % 5) AS DOUBLE) END",
        "DAYS_ENDDATE_FACT": "CASE WHEN o_orderstatus = 'F' THEN "
        f"CAST({d.days('o_orderdate')} + 300 AS DOUBLE) END",
        "AMT_CREDIT_SUM": _PRICE,
        "AMT_CREDIT_SUM_DEBT": "CASE WHEN o_orderkey % 4 = 0 THEN 0e0 WHEN o_orderkey % 9 <> 0 "
        f"THEN {_PRICE} - 1000 * (o_orderkey % 7) END",
        "AMT_CREDIT_SUM_OVERDUE": "o_orderkey % 3 * 1000e0",
        "AMT_CREDIT_MAX_OVERDUE": "CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 13 * 100e0 END",
        "AMT_ANNUITY": "CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN 0e0 "
        "ELSE o_orderkey % 1000 + 500e0 END",
    }


def _bureau_balance(d: Offsets) -> dict[str, str]:
    return {
        "SK_ID_BUREAU": "CASE WHEN l_orderkey % 10 <> 3 THEN l_orderkey END",
        "MONTHS_BALANCE": d.months("l_shipdate"),
        "STATUS": "CASE WHEN l_linenumber = 7 THEN 'X' WHEN l_returnflag = 'A' THEN 'C' "
        "WHEN l_returnflag = 'N' THEN '0' ELSE CAST(l_linenumber % 6 AS STRING) END",
    }


def _credit_card_balance(d: Offsets) -> dict[str, str]:
    return {
        "SK_ID_PREV": "l_orderkey",
        "SK_ID_CURR": _CLIENT,
        "MONTHS_BALANCE": d.months("l_shipdate"),
        "SK_DPD": "CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END",
        "SK_DPD_DEF": "CASE WHEN l_linestatus = 'O' THEN l_linenumber % 3 ELSE 0 END",
        "NAME_CONTRACT_STATUS": "CASE l_returnflag WHEN 'A' THEN 'Active' WHEN 'N' THEN 'Signed' END",
        "AMT_BALANCE": f"CASE WHEN l_partkey % 8 <> 0 THEN {_LINE_PRICE} END",
        "AMT_CREDIT_LIMIT_ACTUAL": "CAST(l_partkey % 4 * 1000000 AS DOUBLE)",
        "AMT_RECIVABLE": f"{_LINE_PRICE} + 7",
        "AMT_TOTAL_RECEIVABLE": f"{_LINE_PRICE} + 9",
        "AMT_PAYMENT_CURRENT": "CAST(l_partkey % 500 * 10 AS DOUBLE)",
        "AMT_PAYMENT_TOTAL_CURRENT": f"{_LINE_PRICE} - 11",
        "AMT_INST_MIN_REGULARITY": "CASE WHEN l_suppkey % 7 <> 0 THEN l_suppkey % 5 * 100e0 END",
        "AMT_DRAWINGS_ATM_CURRENT": "CASE WHEN l_suppkey % 3 <> 0 THEN l_quantity * 100 END",
        "AMT_DRAWINGS_CURRENT": "l_quantity * 150",
        "AMT_DRAWINGS_POS_CURRENT": "l_quantity * 50",
        "CNT_DRAWINGS_ATM_CURRENT": "CASE WHEN l_suppkey % 3 <> 0 THEN l_quantity END",
        "CNT_DRAWINGS_CURRENT": "l_quantity + 1",
        "CNT_DRAWINGS_POS_CURRENT": "l_quantity + 2",
    }


def _pos_cash_balance(d: Offsets) -> dict[str, str]:
    return {
        "SK_ID_PREV": "l_orderkey",
        # loans that change their client, to and from an unknown one, too
        "SK_ID_CURR": "CASE WHEN o_orderkey % 29 = 3 THEN "
        "CASE l_linenumber % 3 WHEN 0 THEN o_custkey WHEN 1 THEN o_custkey % 50 + 1 END "
        f"ELSE {_CLIENT} END",
        "MONTHS_BALANCE": d.months("l_shipdate"),
        "SK_DPD": "CASE WHEN l_partkey % 19 = 0 THEN NULL WHEN l_returnflag = 'R' "
        "THEN l_linenumber ELSE 0 END",
        "SK_DPD_DEF": "CASE WHEN l_linestatus = 'O' THEN l_linenumber % 3 ELSE 0 END",
        "CNT_INSTALMENT": "CASE WHEN l_partkey % 13 <> 0 THEN l_quantity END",
        "CNT_INSTALMENT_FUTURE": "CASE WHEN l_suppkey % 11 <> 0 THEN 2 * l_quantity - 3 END",
        "NAME_CONTRACT_STATUS": _choice("l_partkey * 7919 % 10007", POS_CONTRACT_STATUS),
    }


def _installments_payments(d: Offsets) -> dict[str, str]:
    return {
        "SK_ID_PREV": "l_orderkey",
        "SK_ID_CURR": _CLIENT,
        "NUM_INSTALMENT_NUMBER": "CASE WHEN l_partkey % 23 <> 0 THEN l_linenumber END",
        "DAYS_INSTALMENT": f"CAST({d.days('l_shipdate')} AS DOUBLE)",
        "DAYS_ENTRY_PAYMENT": "CASE WHEN l_suppkey % 17 <> 0 THEN "
        f"CAST({d.days('l_shipdate')} AS DOUBLE) + l_quantity - 25 END",
        "AMT_INSTALMENT": f"CASE WHEN l_partkey % 29 = 0 THEN 0e0 ELSE {_LINE_PRICE} END",
        "AMT_PAYMENT": f"round({_LINE_PRICE} * (1 - l_discount))",
    }


def _previous_application(d: Offsets) -> dict[str, str]:
    def day(multiplier: int, shift: int) -> str:
        return (
            f"CASE o_orderkey * {multiplier} % 5 WHEN 0 THEN {DAYS_SENTINEL}e0 WHEN 1 THEN NULL "
            f"ELSE CAST({d.days('o_orderdate')} + {shift} AS DOUBLE) END"
        )

    categories = {
        column: _choice(f"o_orderkey * {7919 + 2 * i} % 10007", values)
        for i, (column, values) in enumerate(PREVIOUS_APPLICATION.items())
    }
    return {
        "SK_ID_PREV": "o_orderkey",
        "SK_ID_CURR": _CLIENT,
        "DAYS_DECISION": d.days("o_orderdate"),
        "HOUR_APPR_PROCESS_START": "CAST(o_orderkey % 24 AS INTEGER)",
        "AMT_APPLICATION": f"round({_PRICE} * (3 + o_orderkey % 5) / 5e0)",
        "AMT_CREDIT": f"CASE WHEN o_orderkey % 31 = 0 THEN 0e0 ELSE {_PRICE} END",
        "AMT_ANNUITY": "CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 9000 * 10e0 END",
        "AMT_DOWN_PAYMENT": "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 700 * 100e0 END",
        "AMT_GOODS_PRICE": f"{_PRICE} + 13",
        "RATE_DOWN_PAYMENT": "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 64 / 64e0 END",
        "CNT_PAYMENT": "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 4 * 12e0 END",
        "DAYS_FIRST_DRAWING": day(1, 10),
        "DAYS_FIRST_DUE": day(2, 40),
        "DAYS_LAST_DUE_1ST_VERSION": day(3, 400),
        "DAYS_LAST_DUE": day(1, 370),
        "DAYS_TERMINATION": day(4, 390),
        **categories,
    }


_COLUMNS = {
    "application": _application,
    "bureau": _bureau,
    "bureau_balance": _bureau_balance,
    "credit_card_balance": _credit_card_balance,
    "pos_cash_balance": _pos_cash_balance,
    "installments_payments": _installments_payments,
    "previous_application": _previous_application,
}


def credit_table(t: Tables, name: str) -> DataFrame:
    """The credit table as a DataFrame."""
    source = RELATIONS[name]
    if " JOIN " in source:
        left, rest = source.split(" JOIN ")
        right, condition = rest.split(" ON ")
        first, second = condition.split(" = ")
        lines, orders = getattr(t, left), getattr(t, right)
        rows = lines.join(orders, lines[first] == orders[second])
    else:
        rows = getattr(t, source)
    return rows.selectExpr(
        *(f"{expression} AS {column}" for column, expression in _COLUMNS[name](SPARK).items())
    )


def credit_sql(name: str) -> str:
    """The credit table as a subquery."""
    columns = ", ".join(f"{e} AS {column}" for column, e in _COLUMNS[name](CHECK).items())
    return f"(SELECT {columns} FROM {RELATIONS[name]})"
