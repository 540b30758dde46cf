"""Queries: the six feature plans on credit tables made from the test tables.

The SQL side is written down a second time: row features, the conditions of every segment, and the
lists of columns for every aggregate. It groups once per segment, branch by branch, and joins
the branches on the client. Of the plans it uses nothing but the names of the peer-group columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.vocabulary import PREVIOUS_APPLICATION
from creditloom.operators.spec import quoted
from creditloom.plans import (
    application_peers,
    bureau,
    credit_card,
    instalments,
    pos_cash,
    previous_applications,
)
from creditloom.session import scratch_folder
from creditloom.sources.copartitioned import store
from creditloom.workload.analogue import credit_sql, credit_table
from creditloom.workload.registry import Tables, query, sig_sql

#: SQL of the aggregates, by the ending of the names they give.
_AGGREGATES = {
    "MEAN": "avg({})",
    "MIN": "min({})",
    "MAX": "max({})",
    "SUM": "sum({})",
    "SIZE": "count({})",
    "NUNIQUE": "count(DISTINCT {})",
    "VAR": "var_samp({})",
}
#: Columns that are not whole numbers or eighths of them: their means depend on the order of summation.
_FRACTIONS = set(
    "DEBT_PERCENTAGE CREDIT_TO_ANNUITY_RATIO MONTHS_BALANCE_MEAN STATUS_0 STATUS_1 STATUS_12345 STATUS_C "
    "STATUS_X LL_AMT_CREDIT_SUM_OVERDUE LL_DEBT_CREDIT_DIFF LL_STATUS_12345 LIMIT_USE PAYMENT_DIV_MIN "
    "PAYMENT_RATIO LATE_PAYMENT_RATIO APPLICATION_CREDIT_RATIO DOWN_PAYMENT_TO_CREDIT SIMPLE_INTERESTS "
    "REPAYMENT_RATIO".split()
)


def _quote(name: str) -> str:
    return '"' + name + '"'


def comparable(df: DataFrame, keys: Iterable[str], inexact: Iterable[str]) -> DataFrame:
    """All features as doubles, the order-dependent ones at single precision."""
    keys, inexact = set(keys), set(inexact)

    def shown(name: str) -> str:
        if name in keys:
            return quoted(name)
        value = f"CAST({quoted(name)} AS FLOAT)" if name in inexact else quoted(name)
        return f"CAST({value} AS DOUBLE) AS {quoted(name)}"

    return df.selectExpr(*map(shown, df.columns))


def named_column(text: str) -> str:
    """A column in a list; a semicolon stands for a comma that is part of the name."""
    return text.strip().replace(";", ",")


@dataclass(frozen=True)
class Branch:
    """One grouped query of the SQL side, written down here and not taken from a plan.

    ``lists`` has, for each aggregate, the columns it is wanted of, separated by commas. ``where`` is
    a condition on rows, ``clients`` one on the client. ``recorded`` lists columns whose values are
    taken as they were recorded.
    """

    prefix: str
    lists: dict[str, str]
    where: str = "true"
    clients: str = ""
    recorded: tuple[str, ...] = ()

    def features(self) -> list[tuple[str, str, str]]:
        """Name, aggregate and column of each feature."""
        return [
            (f"{self.prefix}{named_column(column)}_{fn}", fn, named_column(column))
            for fn, columns in self.lists.items()
            for column in columns.split(",")
        ]

    def inexact(self) -> list[str]:
        return [
            name
            for name, fn, column in self.features()
            if fn == "VAR" or fn == "MEAN" and column in _FRACTIONS
        ]

    def sql(self, relation: str) -> str:
        inexact, selected = set(self.inexact()), ["SK_ID_CURR"]
        for name, fn, column in self.features():
            source = f"RECORDED_{column}" if column in self.recorded else column
            value = _AGGREGATES[fn].format(_quote(source))
            value = sig_sql(value) if name in inexact else f"CAST({value} AS DOUBLE)"
            selected.append(f"{value} AS {_quote(name)}")
        where = f"SK_ID_CURR IS NOT NULL AND {self.where}"
        if self.clients:
            where += (
                f" AND SK_ID_CURR IN (SELECT SK_ID_CURR FROM {relation} GROUP BY SK_ID_CURR"
                f" HAVING {self.clients})"
            )
        return f"(SELECT {', '.join(selected)} FROM {relation} WHERE {where} GROUP BY SK_ID_CURR)"


def branches_sql(branches: Sequence[Branch], relation: str) -> str:
    """FROM clause: the branch of the whole table, left-joined with the others."""
    first, *others = branches
    text = first.sql(relation)
    for branch in others:
        text += f" LEFT JOIN {branch.sql(relation)} USING (SK_ID_CURR)"
    return text


def inexact_names(branches: Sequence[Branch]) -> list[str]:
    return [name for branch in branches for name in branch.inexact()]


def _names(branches: Sequence[Branch]) -> str:
    names = [name for branch in branches for name, _, _ in branch.features()]
    return ", ".join(["SK_ID_CURR", *map(_quote, names)])


# --- applications ---------------------------------------------------------------------------

_SCORE_LIST = "[EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3]"

APPLICATION_SQL = f"""
WITH usable AS (
  SELECT * FROM {credit_sql("application")}
  WHERE CODE_GENDER <> 'XNA' AND AMT_INCOME_TOTAL < 20000000),
featured AS (
  SELECT *, list_avg({_SCORE_LIST}) AS EXT_SOURCES_MEAN,
         AMT_CREDIT / nullif(AMT_ANNUITY, 0) AS CREDIT_TO_ANNUITY_RATIO,
         CASE WHEN DAYS_BIRTH > -27 * 365 THEN 1 WHEN DAYS_BIRTH > -40 * 365 THEN 2
              WHEN DAYS_BIRTH > -50 * 365 THEN 3 WHEN DAYS_BIRTH > -65 * 365 THEN 4
              WHEN DAYS_BIRTH > -99 * 365 THEN 5 ELSE 0 END AS AGE_RANGE
  FROM usable),
middles AS (
  SELECT {", ".join(application_peers.PEER_KEYS)},
         coalesce(quantile_disc(EXT_SOURCES_MEAN, 0.5), 0) AS GROUP_EXT_SOURCES_MEDIAN
  FROM featured GROUP BY ALL),
spreads AS (
  SELECT {", ".join(application_peers.PEER_KEYS)},
         {", ".join(f"{sig_sql(f'avg({c})')} AS {n}" for n, c in application_peers.MEANS.items())},
         {", ".join(f"{sig_sql(f'stddev_samp({c})')} AS {n}"
                    for n, c in application_peers.SPREADS.items())}
  FROM featured GROUP BY ALL)
SELECT {", ".join(application_peers.COLUMNS)}
FROM middles JOIN spreads USING ({", ".join(application_peers.PEER_KEYS)})
"""


@query("features_application_peers", APPLICATION_SQL)
def features_application_peers(t: Tables) -> DataFrame:
    applications = credit_table(t, "application")
    train = applications.where("SK_ID_CURR % 2 = 0").withColumn("TARGET", F.lit(1))
    test = applications.where("SK_ID_CURR % 2 = 1")
    inexact = [*application_peers.MEANS, *application_peers.SPREADS]
    return comparable(
        application_peers.features(train, test), application_peers.PEER_KEYS, inexact
    )


# --- bureau ---------------------------------------------------------------------------------

_TYPE_FLAGS = ("Consumer credit", "Credit card", "Car loan", "Mortgage", "Microloan")
_STATUS = ("0", "1", "2", "3", "4", "5", "C", "X")

_CREDIT_TYPE = {
    "MEAN": "DAYS_CREDIT, AMT_CREDIT_MAX_OVERDUE, AMT_CREDIT_SUM, AMT_CREDIT_SUM_DEBT, DEBT_PERCENTAGE, "
    "DEBT_CREDIT_DIFF",
    "MAX": "DAYS_CREDIT, AMT_CREDIT_MAX_OVERDUE, AMT_CREDIT_SUM, AMT_CREDIT_SUM_DEBT, "
    "DAYS_CREDIT_ENDDATE",
}
_RECENT_CREDIT = {
    "MEAN": "AMT_CREDIT_MAX_OVERDUE, AMT_CREDIT_SUM_OVERDUE, AMT_CREDIT_SUM_DEBT, DEBT_PERCENTAGE, "
    "DEBT_CREDIT_DIFF, STATUS_0, STATUS_12345",
    "MAX": "AMT_CREDIT_MAX_OVERDUE, AMT_CREDIT_SUM",
    "SUM": "AMT_CREDIT_SUM, AMT_CREDIT_SUM_DEBT",
}
BUREAU_BRANCHES = (
    Branch(
        "BUREAU_",
        {
            "MEAN": "DAYS_CREDIT, AMT_CREDIT_MAX_OVERDUE, AMT_CREDIT_SUM, AMT_CREDIT_SUM_DEBT, "
            "AMT_CREDIT_SUM_OVERDUE, AMT_ANNUITY, DEBT_CREDIT_DIFF, MONTHS_BALANCE_MEAN, "
            "MONTHS_BALANCE_SIZE, STATUS_0, STATUS_1, STATUS_12345, STATUS_C, STATUS_X, "
            "CREDIT_ACTIVE_Active, CREDIT_ACTIVE_Closed, CREDIT_ACTIVE_Sold, "
            "CREDIT_TYPE_Consumer credit, CREDIT_TYPE_Credit card, CREDIT_TYPE_Car loan, "
            "CREDIT_TYPE_Mortgage, CREDIT_TYPE_Microloan, LL_AMT_CREDIT_SUM_OVERDUE, "
            "LL_DEBT_CREDIT_DIFF, LL_STATUS_12345",
            "SUM": "AMT_CREDIT_SUM, AMT_CREDIT_SUM_DEBT, AMT_CREDIT_SUM_OVERDUE, DEBT_CREDIT_DIFF, "
            "MONTHS_BALANCE_SIZE",
            "NUNIQUE": "SK_ID_BUREAU",
            "MAX": "DAYS_CREDIT, DAYS_CREDIT_ENDDATE, AMT_CREDIT_MAX_OVERDUE, AMT_CREDIT_SUM, "
            "AMT_CREDIT_SUM_DEBT, AMT_CREDIT_SUM_OVERDUE",
            "MIN": "DAYS_CREDIT, DAYS_CREDIT_ENDDATE",
            "VAR": "MONTHS_BALANCE_MEAN",
        },
    ),
    Branch(
        "BUREAU_ACTIVE_",
        {
            "MEAN": "DAYS_CREDIT, AMT_CREDIT_MAX_OVERDUE, AMT_CREDIT_SUM_DEBT, AMT_CREDIT_SUM_OVERDUE, "
            "DAYS_CREDIT_UPDATE, DEBT_PERCENTAGE, DEBT_CREDIT_DIFF, CREDIT_TO_ANNUITY_RATIO, "
            "MONTHS_BALANCE_MEAN, MONTHS_BALANCE_SIZE",
            "MAX": "DAYS_CREDIT, DAYS_CREDIT_ENDDATE, AMT_CREDIT_MAX_OVERDUE, AMT_CREDIT_SUM, "
            "AMT_CREDIT_SUM_OVERDUE",
            "MIN": "DAYS_CREDIT_ENDDATE, DAYS_CREDIT_UPDATE",
            "SUM": "AMT_CREDIT_SUM, AMT_CREDIT_SUM_DEBT, MONTHS_BALANCE_SIZE",
            "VAR": "MONTHS_BALANCE_MEAN",
        },
        where='"CREDIT_ACTIVE_Active" = 1',
    ),
    Branch(
        "BUREAU_CLOSED_",
        {
            "MEAN": "AMT_CREDIT_MAX_OVERDUE, AMT_CREDIT_SUM_OVERDUE, AMT_CREDIT_SUM, ENDDATE_DIF, "
            "STATUS_12345",
            "MAX": "DAYS_CREDIT, DAYS_CREDIT_ENDDATE, AMT_CREDIT_MAX_OVERDUE, AMT_CREDIT_SUM, "
            "AMT_CREDIT_SUM_DEBT, DAYS_CREDIT_UPDATE",
            "SUM": "AMT_CREDIT_SUM, AMT_CREDIT_SUM_DEBT",
            "VAR": "DAYS_CREDIT",
        },
        where='"CREDIT_ACTIVE_Closed" = 1',
    ),
    Branch("BUREAU_CONSUMER_", _CREDIT_TYPE, where='"CREDIT_TYPE_Consumer credit" = 1'),
    Branch("BUREAU_CREDIT_", _CREDIT_TYPE, where='"CREDIT_TYPE_Credit card" = 1'),
    Branch("BUREAU_MORTGAGE_", _CREDIT_TYPE, where='"CREDIT_TYPE_Mortgage" = 1'),
    Branch("BUREAU_CAR_", _CREDIT_TYPE, where='"CREDIT_TYPE_Car loan" = 1'),
    Branch("BUREAU_MICROLOAN_", _CREDIT_TYPE, where='"CREDIT_TYPE_Microloan" = 1'),
    Branch("BUREAU_LAST6M_", _RECENT_CREDIT, where="DAYS_CREDIT >= -180"),
    Branch("BUREAU_LAST12M_", _RECENT_CREDIT, where="DAYS_CREDIT >= -360"),
)
_DEBT_SHARES = ", ".join(
    sig_sql(f"{p}AMT_CREDIT_SUM_DEBT_SUM / nullif({p}AMT_CREDIT_SUM_SUM, 0)")
    + f" AS {p}DEBT_OVER_CREDIT"
    for p in ("BUREAU_", "BUREAU_ACTIVE_")
)

BUREAU_SQL = f"""
WITH loan AS (SELECT * FROM {credit_sql("bureau")} WHERE SK_ID_BUREAU IS NOT NULL),
balance AS (
  SELECT SK_ID_BUREAU,
         {", ".join(f"avg(CASE WHEN STATUS = '{x}' THEN 1 ELSE 0 END) AS STATUS_{x}" for x in _STATUS)},
         avg(MONTHS_BALANCE) AS MONTHS_BALANCE_MEAN, count(MONTHS_BALANCE) AS MONTHS_BALANCE_SIZE
  FROM {credit_sql("bureau_balance")} GROUP BY SK_ID_BUREAU),
joined AS (
  SELECT loan.*, balance.* EXCLUDE (SK_ID_BUREAU),
         STATUS_1 + STATUS_2 + STATUS_3 + STATUS_4 + STATUS_5 AS STATUS_12345,
         DAYS_CREDIT_ENDDATE - DAYS_ENDDATE_FACT AS ENDDATE_DIF,
         AMT_CREDIT_SUM / nullif(AMT_CREDIT_SUM_DEBT, 0) AS DEBT_PERCENTAGE,
         AMT_CREDIT_SUM - AMT_CREDIT_SUM_DEBT AS DEBT_CREDIT_DIFF,
         AMT_CREDIT_SUM / nullif(AMT_ANNUITY, 0) AS CREDIT_TO_ANNUITY_RATIO,
         {", ".join(f"CASE WHEN CREDIT_ACTIVE = '{x}' THEN 1 ELSE 0 END AS CREDIT_ACTIVE_{x}"
                    for x in ("Active", "Closed", "Sold"))},
         {", ".join(f"CASE WHEN CREDIT_TYPE = '{x}' THEN 1 ELSE 0 END AS {_quote('CREDIT_TYPE_' + x)}"
                    for x in _TYPE_FLAGS)}
  FROM loan LEFT JOIN balance ON loan.SK_ID_BUREAU = balance.SK_ID_BUREAU),
peers AS (
  SELECT MONTHS_BALANCE_SIZE, avg(AMT_CREDIT_SUM_OVERDUE) AS LL_AMT_CREDIT_SUM_OVERDUE,
         avg(DEBT_CREDIT_DIFF) AS LL_DEBT_CREDIT_DIFF, avg(STATUS_12345) AS LL_STATUS_12345
  FROM joined GROUP BY MONTHS_BALANCE_SIZE),
rows AS (
  SELECT joined.*, peers.* EXCLUDE (MONTHS_BALANCE_SIZE)
  FROM joined LEFT JOIN peers ON joined.MONTHS_BALANCE_SIZE = peers.MONTHS_BALANCE_SIZE),
latest AS (
  SELECT SK_ID_CURR, AMT_CREDIT_MAX_OVERDUE AS BUREAU_LAST_LOAN_MAX_OVERDUE, row_number() OVER (
    PARTITION BY SK_ID_CURR ORDER BY DAYS_CREDIT DESC, SK_ID_BUREAU DESC) AS place FROM loan)
SELECT {_names(BUREAU_BRANCHES)}, BUREAU_LAST_LOAN_MAX_OVERDUE, {_DEBT_SHARES}
FROM {branches_sql(BUREAU_BRANCHES, "rows")}
LEFT JOIN (SELECT * FROM latest WHERE place = 1) USING (SK_ID_CURR)
"""


@query("features_bureau", BUREAU_SQL)
def features_bureau(t: Tables) -> DataFrame:
    wide = bureau.features(credit_table(t, "bureau"), credit_table(t, "bureau_balance"))
    shares = ["BUREAU_DEBT_OVER_CREDIT", "BUREAU_ACTIVE_DEBT_OVER_CREDIT"]
    return comparable(wide, ["SK_ID_CURR"], [*inexact_names(BUREAU_BRANCHES), *shares])


# --- credit card ----------------------------------------------------------------------------

_ACTIVE_CARD = {
    "MEAN": "CNT_DRAWINGS_ATM_CURRENT, AMT_BALANCE, LIMIT_USE",
    "MAX": "SK_DPD, AMT_BALANCE, LIMIT_USE",
    "SUM": "SK_DPD",
}
CREDIT_CARD_BRANCHES = (
    Branch(
        "CC_",
        {
            "MEAN": "AMT_INST_MIN_REGULARITY, AMT_PAYMENT_TOTAL_CURRENT, AMT_TOTAL_RECEIVABLE, "
            "CNT_DRAWINGS_ATM_CURRENT, CNT_DRAWINGS_CURRENT, CNT_DRAWINGS_POS_CURRENT, SK_DPD, "
            "LIMIT_USE, PAYMENT_DIV_MIN",
            "MAX": "AMT_BALANCE, AMT_CREDIT_LIMIT_ACTUAL, AMT_DRAWINGS_ATM_CURRENT, "
            "AMT_DRAWINGS_CURRENT, AMT_DRAWINGS_POS_CURRENT, AMT_INST_MIN_REGULARITY, "
            "AMT_PAYMENT_TOTAL_CURRENT, AMT_TOTAL_RECEIVABLE, CNT_DRAWINGS_ATM_CURRENT, "
            "CNT_DRAWINGS_CURRENT, SK_DPD, SK_DPD_DEF, LIMIT_USE, LATE_PAYMENT",
            "MIN": "MONTHS_BALANCE, PAYMENT_DIV_MIN",
            "SUM": "AMT_DRAWINGS_ATM_CURRENT, AMT_DRAWINGS_CURRENT, AMT_DRAWINGS_POS_CURRENT, "
            "AMT_PAYMENT_TOTAL_CURRENT, CNT_DRAWINGS_ATM_CURRENT, CNT_DRAWINGS_CURRENT, SK_DPD, "
            "SK_DPD_DEF, LATE_PAYMENT",
            "VAR": "AMT_PAYMENT_TOTAL_CURRENT",
        },
    ),
    Branch(
        "CC_LAST_",
        {"MEAN": "AMT_BALANCE", "MAX": "AMT_BALANCE"},
        where="MONTHS_BALANCE = LAST_MONTH",
    ),
    # the whole history of the cards that have a row in the period
    Branch("INS_12M_", _ACTIVE_CARD, where="LAST_MONTH > -12"),
    Branch("INS_24M_", _ACTIVE_CARD, where="LAST_MONTH > -24"),
    Branch("INS_48M_", _ACTIVE_CARD, where="LAST_MONTH > -48"),
)

CREDIT_CARD_SQL = f"""
WITH card AS (SELECT * FROM {credit_sql("credit_card_balance")}),
rows AS (
  SELECT card.*, LAST_MONTH, AMT_BALANCE / nullif(AMT_CREDIT_LIMIT_ACTUAL, 0) AS LIMIT_USE,
         AMT_PAYMENT_CURRENT / nullif(AMT_INST_MIN_REGULARITY, 0) AS PAYMENT_DIV_MIN,
         CASE WHEN SK_DPD > 0 THEN 1 ELSE 0 END AS LATE_PAYMENT
  FROM card LEFT JOIN (SELECT SK_ID_PREV, max(MONTHS_BALANCE) AS LAST_MONTH FROM card
                       GROUP BY SK_ID_PREV) newest ON card.SK_ID_PREV = newest.SK_ID_PREV)
SELECT {_names(CREDIT_CARD_BRANCHES)} FROM {branches_sql(CREDIT_CARD_BRANCHES, "rows")}
"""


@query("features_credit_card", CREDIT_CARD_SQL)
def features_credit_card(t: Tables) -> DataFrame:
    wide = credit_card.features(credit_table(t, "credit_card_balance"))
    return comparable(wide, ["SK_ID_CURR"], inexact_names(CREDIT_CARD_BRANCHES))


# --- point of sale --------------------------------------------------------------------------

_POS_STATUS = ("Active", "Approved", "Completed", "Demand", "Returned to the store", "Signed")

POS_CASH_BRANCHES = (
    Branch(
        "POS_",
        {
            "MEAN": ", ".join(f"NAME_CONTRACT_STATUS_{x}" for x in _POS_STATUS)
            + ", SK_DPD, SK_DPD_DEF, LATE_PAYMENT",
            "MIN": "MONTHS_BALANCE",
            "MAX": "MONTHS_BALANCE, SK_DPD, SK_DPD_DEF",
            "NUNIQUE": "SK_ID_PREV",
            "SIZE": "MONTHS_BALANCE",
            "VAR": "SK_DPD",
            "SUM": "SK_DPD_DEF, SK_DPD",
        },
    ),
)

POS_CASH_SQL = f"""
WITH rows AS (
  SELECT *, CASE WHEN SK_DPD <> 0 THEN 1 WHEN SK_DPD = 0 THEN 0 END AS LATE_PAYMENT,
         {", ".join(
             f"CASE WHEN NAME_CONTRACT_STATUS = '{x}' THEN 1 "
             "WHEN NAME_CONTRACT_STATUS IS NOT NULL THEN 0 END "
             f"AS {_quote('NAME_CONTRACT_STATUS_' + x)}" for x in _POS_STATUS)}
  FROM {credit_sql("pos_cash_balance")}),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY SK_ID_PREV ORDER BY MONTHS_BALANCE,
              SK_ID_CURR NULLS FIRST, CNT_INSTALMENT NULLS FIRST) AS from_start,
         row_number() OVER (PARTITION BY SK_ID_PREV ORDER BY MONTHS_BALANCE DESC,
              SK_ID_CURR DESC NULLS LAST, CNT_INSTALMENT DESC NULLS LAST,
              CNT_INSTALMENT_FUTURE DESC NULLS LAST) AS from_end FROM rows),
loan AS (
  SELECT SK_ID_PREV, avg("NAME_CONTRACT_STATUS_Completed") AS completed,
         CAST(sum(LATE_PAYMENT) AS DOUBLE) AS late_months FROM rows GROUP BY SK_ID_PREV),
ends AS (
  SELECT first.SK_ID_CURR, last.SK_ID_CURR AS latest_client, completed, late_months, last.CNT_INSTALMENT_FUTURE AS remaining,
         CASE WHEN completed > 0 AND first.CNT_INSTALMENT - last.CNT_INSTALMENT > 0 THEN 1
              WHEN completed <= 0 OR first.CNT_INSTALMENT - last.CNT_INSTALMENT <= 0 THEN 0
         END AS completed_before,
         last.CNT_INSTALMENT_FUTURE / nullif(last.CNT_INSTALMENT, 0) AS remaining_ratio
  FROM (SELECT * FROM ordered WHERE from_start = 1) first
  JOIN (SELECT * FROM ordered WHERE from_end = 1) last ON first.SK_ID_PREV = last.SK_ID_PREV
  JOIN loan ON loan.SK_ID_PREV = first.SK_ID_PREV),
per_client AS (
  SELECT SK_ID_CURR, {sig_sql("sum(completed)")} AS POS_LOAN_COMPLETED_MEAN,
         sum(remaining) AS POS_REMAINING_INSTALMENTS,
         CAST(sum(completed_before) AS DOUBLE) AS POS_COMPLETED_BEFORE_MEAN,
         {sig_sql("sum(remaining_ratio)")} AS POS_REMAINING_INSTALMENTS_RATIO
  FROM ends GROUP BY SK_ID_CURR),
late AS (
  SELECT latest_client AS SK_ID_CURR, coalesce(max(late_months), 0) AS LATE_PAYMENT_SUM
  FROM ends GROUP BY latest_client)
SELECT {_names(POS_CASH_BRANCHES)}, POS_LOAN_COMPLETED_MEAN, POS_REMAINING_INSTALMENTS,
       POS_COMPLETED_BEFORE_MEAN, POS_REMAINING_INSTALMENTS_RATIO, LATE_PAYMENT_SUM
FROM {branches_sql(POS_CASH_BRANCHES, "rows")} LEFT JOIN per_client USING (SK_ID_CURR)
     LEFT JOIN late USING (SK_ID_CURR)
"""


@query("features_pos_cash", POS_CASH_SQL)
def features_pos_cash(t: Tables) -> DataFrame:
    wide = pos_cash.features(credit_table(t, "pos_cash_balance"))
    inexact = [
        *inexact_names(POS_CASH_BRANCHES),
        "POS_LOAN_COMPLETED_MEAN",
        "POS_REMAINING_INSTALMENTS_RATIO",
    ]
    return comparable(wide, ["SK_ID_CURR"], inexact)


# --- instalments ----------------------------------------------------------------------------


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 WHEN NOT ({condition}) THEN 0 END"


_PAYMENT_MEANS = (
    "DAYS_ENTRY_PAYMENT, AMT_INSTALMENT, AMT_PAYMENT, DPD, DBD, PAYMENT_DIFFERENCE, PAYMENT_RATIO, "
    "LATE_PAYMENT, SIGNIFICANT_LATE_PAYMENT, LATE_PAYMENT_RATIO, DPD_7, DPD_15"
)
_PERIOD = {
    "MAX": "DAYS_ENTRY_PAYMENT, AMT_INSTALMENT, AMT_PAYMENT, DPD, DBD",
    "MEAN": _PAYMENT_MEANS,
    "MIN": "DAYS_ENTRY_PAYMENT, AMT_INSTALMENT, AMT_PAYMENT",
    "SUM": "AMT_INSTALMENT, AMT_PAYMENT",
    "SIZE": "SK_ID_PREV",
    "VAR": "DPD, DBD",
}


def _one_loan_due(months: int) -> str:
    return f"count(DISTINCT SK_ID_PREV) FILTER (WHERE DAYS_INSTALMENT >= -30 * {months}) = 1"


INSTALMENTS_BRANCHES = (
    Branch(
        "INS_",
        {
            "MEAN": f"{_PAYMENT_MEANS}, PAID_OVER",
            "MAX": "DAYS_ENTRY_PAYMENT, AMT_INSTALMENT, AMT_PAYMENT, DPD, DBD",
            "VAR": "DPD, DBD",
            "MIN": "DAYS_ENTRY_PAYMENT, AMT_INSTALMENT, AMT_PAYMENT",
            "SUM": "AMT_INSTALMENT, AMT_PAYMENT, LATE_PAYMENT, SIGNIFICANT_LATE_PAYMENT",
            "SIZE": "SK_ID_PREV",
            "NUNIQUE": "SK_ID_PREV",
        },
    ),
    Branch("INS_36M_", _PERIOD, clients=_one_loan_due(36)),
    Branch("INS_60M_", _PERIOD, clients=_one_loan_due(60)),
)

INSTALMENTS_SQL = f"""
WITH paid AS (SELECT * FROM {credit_sql("installments_payments")}),
grouped AS (
  SELECT SK_ID_PREV, NUM_INSTALMENT_NUMBER, sum(AMT_PAYMENT) AS AMT_PAYMENT_GROUPED
  FROM paid GROUP BY SK_ID_PREV, NUM_INSTALMENT_NUMBER),
flagged AS (
  SELECT paid.*, AMT_INSTALMENT - AMT_PAYMENT_GROUPED AS PAYMENT_DIFFERENCE,
         AMT_INSTALMENT / nullif(AMT_PAYMENT_GROUPED, 0) AS PAYMENT_RATIO,
         {_flag("AMT_PAYMENT / nullif(AMT_INSTALMENT, 0) > 0")} AS PAID_OVER,
         {_flag("DAYS_ENTRY_PAYMENT > DAYS_INSTALMENT")} AS DPD,
         {_flag("DAYS_INSTALMENT > DAYS_ENTRY_PAYMENT")} AS DBD,
         AMT_PAYMENT / nullif(AMT_INSTALMENT, 0) AS PAID_SHARE
  FROM paid LEFT JOIN grouped ON paid.SK_ID_PREV = grouped.SK_ID_PREV
       AND paid.NUM_INSTALMENT_NUMBER = grouped.NUM_INSTALMENT_NUMBER),
rows AS (
  SELECT *, DBD AS LATE_PAYMENT, PAID_SHARE * DBD AS LATE_PAYMENT_RATIO,
         {_flag("PAID_SHARE * DBD > 0.05e0")} AS SIGNIFICANT_LATE_PAYMENT,
         {_flag("DPD >= 7")} AS DPD_7, {_flag("DPD >= 15")} AS DPD_15
  FROM flagged)
SELECT {_names(INSTALMENTS_BRANCHES)} FROM {branches_sql(INSTALMENTS_BRANCHES, "rows")}
"""


@query("features_instalments", INSTALMENTS_SQL)
def features_instalments(t: Tables) -> DataFrame:
    wide = instalments.features(credit_table(t, "installments_payments"))
    return comparable(wide, ["SK_ID_CURR"], inexact_names(INSTALMENTS_BRANCHES))


@query("features_instalments_copartitioned", INSTALMENTS_SQL)
def features_instalments_copartitioned(t: Tables) -> DataFrame:
    """The same from payments stored by client; clients of many payments go the ordinary way."""
    payments = store(
        credit_table(t, "installments_payments"),
        scratch_folder(t.spark) + "/payments",
        "SK_ID_CURR",
        sort=("SK_ID_PREV", "NUM_INSTALMENT_NUMBER"),
        hot_rows=100,
    )
    wide = instalments.stored_features(payments)
    return comparable(wide, ["SK_ID_CURR"], inexact_names(INSTALMENTS_BRANCHES))


# --- previous applications ------------------------------------------------------------------

_PREVIOUS_FLAGS = ", ".join(
    f"CASE WHEN {column} = '{value}' THEN 1 WHEN {column} IS NOT NULL THEN 0 END "
    f"AS {_quote(column + '_' + value)}"
    for column, values in PREVIOUS_APPLICATION.items()
    for value in values
)
_DAY_COLUMNS = (
    "DAYS_FIRST_DRAWING",
    "DAYS_FIRST_DUE",
    "DAYS_LAST_DUE_1ST_VERSION",
    "DAYS_LAST_DUE",
    "DAYS_TERMINATION",
)
#: Approved and active applications keep their days as recorded.
_AS_RECORDED = (*_DAY_COLUMNS, "DAYS_LAST_DUE_DIFF")
_LOAN_TYPES = (
    "NAME_CONTRACT_TYPE_Consumer loans, NAME_CONTRACT_TYPE_Cash loans, "
    "NAME_CONTRACT_TYPE_Revolving loans"
)
_BY_CONTRACT = {
    "VAR": "SIMPLE_INTERESTS, APPLICATION_CREDIT_DIFF",
    "MAX": "AMT_ANNUITY, SIMPLE_INTERESTS, APPLICATION_CREDIT_RATIO, DAYS_DECISION, "
    "DAYS_LAST_DUE_1ST_VERSION",
    "MIN": "SIMPLE_INTERESTS, APPLICATION_CREDIT_DIFF, APPLICATION_CREDIT_RATIO",
    "SUM": "AMT_CREDIT",
    "MEAN": "AMT_ANNUITY, SIMPLE_INTERESTS, APPLICATION_CREDIT_RATIO, DAYS_LAST_DUE_1ST_VERSION, "
    "CNT_PAYMENT",
}
_RECENT_APPLICATIONS = {
    "MEAN": "AMT_ANNUITY, SIMPLE_INTERESTS, DAYS_DECISION, DAYS_LAST_DUE_1ST_VERSION, "
    f"APPLICATION_CREDIT_RATIO, {_LOAN_TYPES}",
    "MIN": "DAYS_DECISION, DAYS_LAST_DUE_1ST_VERSION, APPLICATION_CREDIT_DIFF, "
    "APPLICATION_CREDIT_RATIO",
    "MAX": "AMT_ANNUITY, SIMPLE_INTERESTS, DAYS_LAST_DUE_1ST_VERSION, APPLICATION_CREDIT_RATIO",
    "SUM": "AMT_CREDIT",
}
#: Categories whose flags are averaged, by column. A comma inside a name is written as a semicolon.
_FLAG_MEANS = {
    "NAME_CONTRACT_STATUS": "Approved, Canceled, Refused, Unused offer",
    "NAME_CONTRACT_TYPE": "Cash loans, Consumer loans, Revolving loans, XNA",
    "CHANNEL_TYPE": "AP+ (Cash loan), Car dealer, Channel of corporate sales, Contact center, "
    "Country-wide, Credit and cash offices, Regional / Local, Stone",
    "NAME_TYPE_SUITE": "Children, Family, Group of people, Other_A, Other_B, Spouse; partner, "
    "Unaccompanied",
    "NAME_YIELD_GROUP": "XNA, high, low_action, low_normal, middle",
    "PRODUCT_COMBINATION": "Card Street, Card X-Sell, Cash, Cash Street: high, Cash Street: low, "
    "Cash Street: middle, Cash X-Sell: high, Cash X-Sell: low, Cash X-Sell: middle, "
    "POS household with interest, POS household without interest, POS industry with interest, "
    "POS industry without interest, POS mobile with interest, POS mobile without interest, "
    "POS other with interest, POS others without interest",
    "NAME_PRODUCT_TYPE": "XNA, walk-in, x-sell",
    "NAME_CLIENT_TYPE": "New, Refreshed, Repeater, XNA",
}
_ALL_FLAGS = ", ".join(
    f"{column}_{value.strip()}"
    for column, values in _FLAG_MEANS.items()
    for value in values.split(",")
)
PREVIOUS_BRANCHES = (
    Branch(
        "PREV_",
        {
            "MAX": "AMT_ANNUITY, AMT_DOWN_PAYMENT, HOUR_APPR_PROCESS_START, RATE_DOWN_PAYMENT, "
            "DAYS_DECISION, CNT_PAYMENT, DAYS_TERMINATION, CREDIT_TO_ANNUITY_RATIO, "
            "APPLICATION_CREDIT_DIFF, APPLICATION_CREDIT_RATIO",
            "MEAN": f"{_ALL_FLAGS}, AMT_ANNUITY, AMT_DOWN_PAYMENT, HOUR_APPR_PROCESS_START, "
            "RATE_DOWN_PAYMENT, DAYS_DECISION, CNT_PAYMENT, CREDIT_TO_ANNUITY_RATIO, "
            "APPLICATION_CREDIT_DIFF, APPLICATION_CREDIT_RATIO, DOWN_PAYMENT_TO_CREDIT",
            "MIN": "AMT_ANNUITY, HOUR_APPR_PROCESS_START, DAYS_DECISION, APPLICATION_CREDIT_DIFF, "
            "APPLICATION_CREDIT_RATIO",
            "VAR": "APPLICATION_CREDIT_RATIO",
            "NUNIQUE": "SK_ID_PREV",
        },
    ),
    Branch(
        "PREV_ACTIVE_",
        {
            "MAX": "AMT_ANNUITY, AMT_APPLICATION, AMT_DOWN_PAYMENT, DAYS_LAST_DUE_1ST_VERSION, "
            "INSTALMENT_PAYMENT_DIFF, REMAINING_DEBT",
            "MEAN": "SIMPLE_INTERESTS, AMT_APPLICATION, AMT_DOWN_PAYMENT, DAYS_DECISION, CNT_PAYMENT, "
            "DAYS_LAST_DUE_1ST_VERSION, INSTALMENT_PAYMENT_DIFF, REMAINING_DEBT, REPAYMENT_RATIO",
            "SUM": "AMT_ANNUITY, AMT_CREDIT, CNT_PAYMENT, REMAINING_DEBT, AMT_PAYMENT",
            "MIN": "DAYS_DECISION, DAYS_LAST_DUE_1ST_VERSION",
            "NUNIQUE": "SK_ID_PREV",
        },
        where='"NAME_CONTRACT_STATUS_Approved" = 1 AND RECORDED_DAYS_LAST_DUE = 365243',
        recorded=_AS_RECORDED,
    ),
    Branch(
        "APPROVED_",
        {
            "MAX": "AMT_ANNUITY, AMT_CREDIT, AMT_DOWN_PAYMENT, AMT_GOODS_PRICE, "
            "HOUR_APPR_PROCESS_START, CNT_PAYMENT, CREDIT_TO_ANNUITY_RATIO, APPLICATION_CREDIT_DIFF, "
            "APPLICATION_CREDIT_RATIO, DAYS_FIRST_DRAWING, DAYS_LAST_DUE_1ST_VERSION, DAYS_LAST_DUE, "
            "DAYS_LAST_DUE_DIFF, SIMPLE_INTERESTS",
            "MEAN": "AMT_ANNUITY, AMT_CREDIT, DAYS_DECISION, CNT_PAYMENT, DAYS_TERMINATION, "
            "CREDIT_TO_ANNUITY_RATIO, APPLICATION_CREDIT_RATIO, DAYS_FIRST_DRAWING, DAYS_FIRST_DUE, "
            "DAYS_LAST_DUE_1ST_VERSION, DAYS_LAST_DUE, DAYS_LAST_DUE_DIFF, SIMPLE_INTERESTS",
            "MIN": "AMT_ANNUITY, AMT_CREDIT, HOUR_APPR_PROCESS_START, DAYS_DECISION, "
            "APPLICATION_CREDIT_RATIO, DAYS_FIRST_DUE, DAYS_LAST_DUE_1ST_VERSION, DAYS_LAST_DUE_DIFF, "
            "SIMPLE_INTERESTS",
            "NUNIQUE": "SK_ID_PREV",
        },
        where='"NAME_CONTRACT_STATUS_Approved" = 1',
        recorded=_AS_RECORDED,
    ),
    Branch(
        "REFUSED_",
        {
            "VAR": "APPLICATION_CREDIT_DIFF",
            "MAX": "AMT_APPLICATION, AMT_CREDIT, DAYS_DECISION, CNT_PAYMENT, APPLICATION_CREDIT_DIFF",
            "MIN": "AMT_CREDIT, DAYS_DECISION, APPLICATION_CREDIT_DIFF, APPLICATION_CREDIT_RATIO",
            "MEAN": "AMT_APPLICATION, DAYS_DECISION, CNT_PAYMENT, APPLICATION_CREDIT_DIFF, "
            f"APPLICATION_CREDIT_RATIO, {_LOAN_TYPES}",
        },
        where='"NAME_CONTRACT_STATUS_Refused" = 1',
    ),
    Branch("PREV_Consumer_", _BY_CONTRACT, where='"NAME_CONTRACT_TYPE_Consumer loans" = 1'),
    Branch("PREV_Cash_", _BY_CONTRACT, where='"NAME_CONTRACT_TYPE_Cash loans" = 1'),
    Branch(
        "PREV_LATE_",
        {
            "MEAN": f"DAYS_DECISION, DAYS_LAST_DUE_1ST_VERSION, {_LOAN_TYPES}",
            "MIN": "DAYS_DECISION, DAYS_LAST_DUE_1ST_VERSION, APPLICATION_CREDIT_DIFF",
            "MAX": "DAYS_DECISION, DAYS_LAST_DUE_1ST_VERSION",
        },
        where="PAID_LATE",
    ),
    Branch("PREV_LAST12M_", _RECENT_APPLICATIONS, where="DAYS_DECISION >= -360"),
    Branch("PREV_LAST24M_", _RECENT_APPLICATIONS, where="DAYS_DECISION >= -720"),
)
_CLEANED = ", ".join(f"CASE WHEN {c} <> 365243 THEN CAST({c} AS INTEGER) END AS {c}" for c in _DAY_COLUMNS)
_RECORDED = ", ".join(f"{c} AS RECORDED_{c}" for c in _DAY_COLUMNS)

PREVIOUS_SQL = f"""
WITH previous AS (SELECT * FROM {credit_sql("previous_application")}),
payment AS (SELECT * FROM {credit_sql("installments_payments")}),
cleaned AS (
  SELECT * EXCLUDE ({", ".join(_DAY_COLUMNS)}), {_CLEANED}, {_RECORDED} FROM previous),
paid AS (
  SELECT SK_ID_PREV, sum(AMT_INSTALMENT) AS AMT_INSTALMENT, sum(AMT_PAYMENT) AS AMT_PAYMENT
  FROM payment GROUP BY SK_ID_PREV),
late AS (SELECT DISTINCT SK_ID_PREV FROM payment WHERE DAYS_ENTRY_PAYMENT > DAYS_INSTALMENT),
rows AS (
  SELECT cleaned.*, {_PREVIOUS_FLAGS},
         AMT_APPLICATION - AMT_CREDIT AS APPLICATION_CREDIT_DIFF,
         AMT_APPLICATION / nullif(AMT_CREDIT, 0) AS APPLICATION_CREDIT_RATIO,
         AMT_CREDIT / nullif(AMT_ANNUITY, 0) AS CREDIT_TO_ANNUITY_RATIO,
         AMT_DOWN_PAYMENT / nullif(AMT_CREDIT, 0) AS DOWN_PAYMENT_TO_CREDIT,
         AMT_ANNUITY / nullif(AMT_CREDIT, 0)
           - CNT_PAYMENT / nullif(CNT_PAYMENT, 0) / nullif(CNT_PAYMENT, 0) AS SIMPLE_INTERESTS,
         DAYS_LAST_DUE_1ST_VERSION - DAYS_LAST_DUE AS DAYS_LAST_DUE_DIFF,
         RECORDED_DAYS_LAST_DUE_1ST_VERSION - RECORDED_DAYS_LAST_DUE AS RECORDED_DAYS_LAST_DUE_DIFF,
         AMT_PAYMENT, AMT_INSTALMENT - AMT_PAYMENT AS INSTALMENT_PAYMENT_DIFF,
         AMT_CREDIT - AMT_PAYMENT AS REMAINING_DEBT,
         AMT_PAYMENT / nullif(AMT_CREDIT, 0) AS REPAYMENT_RATIO,
         late.SK_ID_PREV IS NOT NULL AS PAID_LATE
  FROM cleaned LEFT JOIN paid ON cleaned.SK_ID_PREV = paid.SK_ID_PREV
       LEFT JOIN late ON cleaned.SK_ID_PREV = late.SK_ID_PREV),
wide AS (SELECT * FROM {branches_sql(PREVIOUS_BRANCHES, "rows")})
SELECT {_names(PREVIOUS_BRANCHES)},
       {sig_sql("PREV_ACTIVE_AMT_PAYMENT_SUM / nullif(PREV_ACTIVE_AMT_CREDIT_SUM, 0)")}
         AS TOTAL_REPAYMENT_RATIO FROM wide
"""


@query("features_previous_applications", PREVIOUS_SQL)
def features_previous_applications(t: Tables) -> DataFrame:
    wide = previous_applications.features(
        credit_table(t, "previous_application"), credit_table(t, "installments_payments")
    )
    inexact = [*inexact_names(PREVIOUS_BRANCHES), "TOTAL_REPAYMENT_RATIO"]
    return comparable(wide, ["SK_ID_CURR"], inexact)
