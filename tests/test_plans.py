"""The six feature plans on hand-made rows with known answers."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from creditloom import schemas
from creditloom.functions import vocabulary as v
from creditloom.plans import (
    application_peers,
    bureau,
    credit_card,
    instalments,
    pos_cash,
    previous_applications,
)


def table(spark, schema, rows):
    """Rows given as dicts; absent columns are NULL."""
    names = schema.fieldNames()
    unknown = {k for row in rows for k in row} - set(names)
    assert not unknown, unknown
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def by_client(frame):
    rows = {r.SK_ID_CURR: r for r in frame.collect()}
    assert None not in rows
    assert len(rows) == frame.count()
    return rows


@pytest.mark.parametrize(
    ("plan", "columns"),
    [
        (application_peers, 14),
        (bureau, 156),
        (credit_card, 59),
        (pos_cash, 24),
        (instalments, 80),
        (previous_applications, 235),
    ],
)
def test_width_of_the_published_tables(plan, columns):
    assert len(plan.COLUMNS) == len(set(plan.COLUMNS)) == columns


# --- applications ---------------------------------------------------------------------------


def test_application_peers(spark):
    peer = {
        "ORGANIZATION_TYPE": "Bank",
        "NAME_EDUCATION_TYPE": "Higher",
        "OCCUPATION_TYPE": "Clerk",
        "CODE_GENDER": "F",
        "DAYS_BIRTH": -30 * 365,
    }

    def person(client, **changes):
        base = {"SK_ID_CURR": client, "AMT_INCOME_TOTAL": 100.0, **peer}
        return base | {"AMT_CREDIT": 50.0, "AMT_ANNUITY": 10.0, "EXT_SOURCE_1": 0.5} | changes

    train = table(
        spark,
        schemas.APPLICATION_TRAIN,
        [
            person(1, TARGET=1),
            person(2, EXT_SOURCE_1=None, EXT_SOURCE_2=0.1, AMT_INCOME_TOTAL=300.0),
            person(3, CODE_GENDER="XNA"),
            person(4, CODE_GENDER=None),
            person(5, AMT_INCOME_TOTAL=20_000_000.0),
            person(6, OCCUPATION_TYPE=None),
            person(7, DAYS_BIRTH=None),
        ],
    )
    test = table(
        spark,
        schemas.APPLICATION,
        [
            person(11, EXT_SOURCE_1=None, AMT_ANNUITY=0.0),
            person(12, EXT_SOURCE_1=0.9, EXT_SOURCE_2=0.3),
            person(13, DAYS_BIRTH=-70 * 365, EXT_SOURCE_1=None),
        ],
    )
    for hot_rows in (10**9, 1):
        rows = application_peers.features(train, test, hot_rows=hot_rows).collect()
        result = {r.AGE_RANGE: r for r in rows}
        assert sorted(result) == [2, 5]
        group = result[2]
        assert group.GROUP_EXT_SOURCES_MEDIAN == 0.5  # of 0.1, 0.5, 0.6 and one unknown
        assert group.GROUP_INCOME_MEAN == 150.0 and group.GROUP_CREDIT_MEAN == 50.0
        assert group.GROUP_CREDIT_TO_ANNUITY_MEAN == 5.0  # the zero annuity has no ratio
        assert group.GROUP_INCOME_STD == pytest.approx(statistics.stdev([100, 300, 100, 100]))
        assert group.GROUP_EXT_SOURCES_STD == pytest.approx(statistics.stdev([0.5, 0.1, 0.6]))
        single = result[5]
        assert single.GROUP_EXT_SOURCES_MEDIAN == 0.0 and single.GROUP_INCOME_STD is None
    assert application_peers.usable(train).where("DAYS_EMPLOYED = 365243").count() == 4


# --- bureau ---------------------------------------------------------------------------------


def test_bureau(spark):
    loans = table(
        spark,
        schemas.BUREAU,
        [
            {"SK_ID_CURR": 1, "SK_ID_BUREAU": 1, "CREDIT_ACTIVE": "Active", "DAYS_CREDIT": -100,
             "CREDIT_TYPE": "Mortgage", "AMT_CREDIT_SUM": 100.0, "AMT_CREDIT_SUM_DEBT": 50.0,
             "AMT_CREDIT_MAX_OVERDUE": 7.0, "AMT_CREDIT_SUM_OVERDUE": 4.0},
            {"SK_ID_CURR": 1, "SK_ID_BUREAU": 2, "CREDIT_ACTIVE": "Closed", "DAYS_CREDIT": -400,
             "AMT_CREDIT_SUM": 60.0, "AMT_CREDIT_SUM_DEBT": 0.0, "DAYS_CREDIT_ENDDATE": 10.0,
             "DAYS_ENDDATE_FACT": 4.0, "AMT_CREDIT_SUM_OVERDUE": 8.0},
            {"SK_ID_CURR": 2, "SK_ID_BUREAU": 3, "DAYS_CREDIT": -5, "AMT_CREDIT_MAX_OVERDUE": 1.0},
            {"SK_ID_CURR": 2, "SK_ID_BUREAU": 4, "DAYS_CREDIT": -5, "CREDIT_ACTIVE": "Gone",
             "CREDIT_TYPE": "", "AMT_CREDIT_SUM_OVERDUE": 100.0},
            {"SK_ID_CURR": None, "SK_ID_BUREAU": 5, "DAYS_CREDIT": -5},
        ],
    )
    history = [(1, 0, "0"), (1, -1, "1"), (2, -7, "C"), (2, -8, "5"), (4, -3, "X"), (None, -1, "0")]
    balance = spark.createDataFrame(history, schemas.BUREAU_BALANCE)
    result = bureau.features(loans, balance)
    assert result.columns == bureau.COLUMNS
    clients = by_client(result)
    assert sorted(clients) == [1, 2]
    one, two = clients[1], clients[2]
    assert one.BUREAU_STATUS_12345_MEAN == 0.5
    assert one.BUREAU_MONTHS_BALANCE_SIZE_SUM == 4
    # Peers share the number of months on record: loans 1 and 2 have two, loan 4 has one.
    assert one.BUREAU_LL_AMT_CREDIT_SUM_OVERDUE_MEAN == 6.0
    assert two.BUREAU_LL_AMT_CREDIT_SUM_OVERDUE_MEAN == 100.0
    assert one.BUREAU_CREDIT_ACTIVE_Active_MEAN == 0.5
    assert two.BUREAU_CREDIT_ACTIVE_Active_MEAN == 0.0  # unknown categories count as zero
    assert one.BUREAU_MORTGAGE_DAYS_CREDIT_MAX == -100
    assert one.BUREAU_CLOSED_ENDDATE_DIF_MEAN == 6.0 and one.BUREAU_CLOSED_DAYS_CREDIT_VAR is None
    assert one.BUREAU_ACTIVE_DEBT_PERCENTAGE_MEAN == 2.0
    assert one.BUREAU_LAST6M_AMT_CREDIT_SUM_SUM == 100.0
    assert one.BUREAU_LAST_LOAN_MAX_OVERDUE == 7.0
    assert two.BUREAU_LAST_LOAN_MAX_OVERDUE is None  # tied days: the higher loan id, no amount
    assert one.BUREAU_DEBT_OVER_CREDIT == 50.0 / 160.0
    assert one.BUREAU_ACTIVE_DEBT_OVER_CREDIT == 0.5
    assert two.BUREAU_ACTIVE_DEBT_OVER_CREDIT is None
    assert two.BUREAU_ACTIVE_MONTHS_BALANCE_SIZE_SUM is None
    assert (one.BUREAU_SK_ID_BUREAU_NUNIQUE, two.BUREAU_SK_ID_BUREAU_NUNIQUE) == (2, 2)


# --- credit card ----------------------------------------------------------------------------


def test_credit_card(spark):
    def month(client, card, offset, balance, **more):
        return {"SK_ID_CURR": client, "SK_ID_PREV": card, "MONTHS_BALANCE": offset,
                "AMT_BALANCE": balance, "AMT_CREDIT_LIMIT_ACTUAL": 100.0, "SK_DPD": 0} | more

    cards = table(
        spark,
        schemas.CREDIT_CARD_BALANCE,
        [
            month(1, 10, -1, 50.0, SK_DPD=3),
            month(1, 10, -40, 90.0),
            month(1, 11, -12, 20.0),
            month(1, 11, -12, 30.0, AMT_CREDIT_LIMIT_ACTUAL=0.0),
            month(2, 20, -60, None),
            month(None, 30, -1, 1.0),
            month(3, None, -1, 5.0),
        ],
    )
    result = credit_card.features(cards)
    assert result.columns == credit_card.COLUMNS
    one, two, three = (by_client(result)[i] for i in (1, 2, 3))
    # The latest rows: one of card 10, both tied ones of card 11.
    assert one.CC_LAST_AMT_BALANCE_MEAN == pytest.approx(100 / 3)
    assert one.CC_LAST_AMT_BALANCE_MAX == 50.0
    # Card 10 was active in the last year: its whole history counts. Card 11 was not.
    assert (one.INS_12M_AMT_BALANCE_MEAN, one.INS_12M_AMT_BALANCE_MAX) == (70.0, 90.0)
    assert one.INS_24M_AMT_BALANCE_MEAN == 47.5
    assert one.CC_LIMIT_USE_MAX == 0.9 and one.CC_LATE_PAYMENT_SUM == 1
    assert two.INS_48M_SK_DPD_SUM is None and two.CC_SK_DPD_SUM == 0
    assert three.CC_MONTHS_BALANCE_MIN == -1
    assert three.INS_12M_AMT_BALANCE_MEAN is None  # the card is unknown
    assert three.CC_LAST_AMT_BALANCE_MAX is None


# --- point of sale --------------------------------------------------------------------------


def test_pos_cash(spark):
    def month(client, loan, offset, term, left, late, status="Active"):
        return {"SK_ID_CURR": client, "SK_ID_PREV": loan, "MONTHS_BALANCE": offset,
                "CNT_INSTALMENT": term, "CNT_INSTALMENT_FUTURE": left, "SK_DPD": late,
                "SK_DPD_DEF": 0, "NAME_CONTRACT_STATUS": status}

    balance = table(
        spark,
        schemas.POS_CASH_BALANCE,
        [
            month(1, 10, -3, 12.0, 12.0, 5),
            month(1, 10, -2, 12.0, 11.0, 0),
            month(1, 10, -1, 6.0, 0.0, 9, "Completed"),
            month(1, 11, -5, 10.0, 8.0, 1),
            month(1, 11, -4, 10.0, 7.0, None, None),
            month(1, 12, -4, 10.0, None, 1),
            month(2, 20, -4, 0.0, 3.0, None),
            month(3, None, -4, 4.0, 3.0, 2),
            month(None, 40, -4, 4.0, 3.0, 2),
        ],
    )
    result = pos_cash.features(balance)
    assert result.columns == pos_cash.COLUMNS
    one, two, three = (by_client(result)[i] for i in (1, 2, 3))
    assert one.POS_SK_ID_PREV_NUNIQUE == 3 and one.POS_MONTHS_BALANCE_SIZE == 6
    assert one.POS_NAME_CONTRACT_STATUS_Completed_MEAN == 0.2  # one status is unknown
    assert one.POS_LATE_PAYMENT_MEAN == 0.8
    assert one.POS_LOAN_COMPLETED_MEAN == pytest.approx(1 / 3)
    assert one.POS_REMAINING_INSTALMENTS == 7.0
    assert one.POS_COMPLETED_BEFORE_MEAN == 1
    assert one.POS_REMAINING_INSTALMENTS_RATIO == pytest.approx(0.7)
    assert one.LATE_PAYMENT_SUM == 2.0
    assert two.POS_REMAINING_INSTALMENTS_RATIO is None and two.LATE_PAYMENT_SUM == 0.0
    assert three.LATE_PAYMENT_SUM is None and three.POS_REMAINING_INSTALMENTS == 3.0
    averaged = by_client(pos_cash.features(balance, late_of_top=3))
    assert averaged[1].LATE_PAYMENT_SUM == pytest.approx(4 / 3)
    assert averaged[2].LATE_PAYMENT_SUM == 0.0 and averaged[3].LATE_PAYMENT_SUM is None


# --- instalments ----------------------------------------------------------------------------


def test_instalments(spark):
    def paid(client, loan, number, due, entry, owed, amount):
        return {"SK_ID_CURR": client, "SK_ID_PREV": loan, "NUM_INSTALMENT_NUMBER": number,
                "DAYS_INSTALMENT": due, "DAYS_ENTRY_PAYMENT": entry,
                "AMT_INSTALMENT": owed, "AMT_PAYMENT": amount}

    payments = table(
        spark,
        schemas.INSTALLMENTS_PAYMENTS,
        [
            paid(1, 10, 1, -100.0, -90.0, 10.0, 4.0),  # late, in two parts
            paid(1, 10, 1, -100.0, -120.0, 10.0, 6.0),
            paid(1, 11, 1, -1500.0, -1500.0, 0.0, 5.0),
            paid(2, 20, 1, -100.0, None, 8.0, None),
            paid(2, 21, 1, -100.0, -101.0, 8.0, 8.0),
            paid(None, 30, 1, -1.0, -1.0, 1.0, 1.0),
        ],
    )
    result = instalments.features(payments)
    assert result.columns == instalments.COLUMNS
    one, two = (by_client(result)[i] for i in (1, 2))
    assert one.INS_DPD_MEAN == pytest.approx(1 / 3) and one.INS_DBD_MEAN == pytest.approx(1 / 3)
    assert one.INS_PAYMENT_DIFFERENCE_MEAN == pytest.approx(-5 / 3)  # parts are added up
    assert one.INS_LATE_PAYMENT_RATIO_MEAN == pytest.approx(0.3)  # no ratio for a zero amount
    assert one.INS_SIGNIFICANT_LATE_PAYMENT_SUM == 1
    assert one.INS_DPD_7_MEAN == 0.0 and one.INS_PAID_OVER_MEAN == 1.0
    # One loan due within 36 months: the whole history counts, also the older loan.
    assert one.INS_36M_SK_ID_PREV_SIZE == 3 and one.INS_36M_AMT_PAYMENT_SUM == 15.0
    assert one.INS_60M_SK_ID_PREV_SIZE is None  # two loans within 60 months
    assert two.INS_36M_AMT_INSTALMENT_SUM is None
    assert two.INS_SK_ID_PREV_NUNIQUE == 2 and two.INS_DPD_VAR is None


# --- previous applications ------------------------------------------------------------------


def test_previous_applications(spark):
    def asked(client, loan, status, day, **more):
        return {"SK_ID_CURR": client, "SK_ID_PREV": loan, "NAME_CONTRACT_STATUS": status,
                "DAYS_DECISION": day, "NAME_CONTRACT_TYPE": "Cash loans"} | more

    sentinel = float(v.DAYS_SENTINEL)
    previous = table(
        spark,
        schemas.PREVIOUS_APPLICATION,
        [
            asked(1, 10, "Approved", -100, DAYS_LAST_DUE=sentinel, AMT_CREDIT=100.0,
                  AMT_APPLICATION=80.0, AMT_ANNUITY=20.0, CNT_PAYMENT=10.0,
                  DAYS_LAST_DUE_1ST_VERSION=sentinel, DAYS_FIRST_DUE=sentinel),
            asked(1, 11, "Approved", -500, DAYS_LAST_DUE=-50.0, AMT_CREDIT=50.0,
                  DAYS_LAST_DUE_1ST_VERSION=-40.0, DAYS_FIRST_DUE=-300.0),
            asked(1, 12, "Refused", -900, DAYS_LAST_DUE_1ST_VERSION=sentinel, AMT_CREDIT=0.0,
                  AMT_APPLICATION=5.0, CHANNEL_TYPE="Regional / Local"),
            asked(2, 20, None, -10, NAME_CONTRACT_TYPE=None, NAME_TYPE_SUITE="Spouse, partner"),
            asked(2, 21, "Approved", -10, DAYS_LAST_DUE=sentinel, AMT_CREDIT=10.0),
            asked(None, 30, "Approved", -1),
        ],
    )
    payments = table(
        spark,
        schemas.INSTALLMENTS_PAYMENTS,
        [
            {"SK_ID_PREV": 10, "AMT_INSTALMENT": 30.0, "AMT_PAYMENT": 20.0,
             "DAYS_INSTALMENT": -9.0, "DAYS_ENTRY_PAYMENT": -9.0},
            {"SK_ID_PREV": 10, "AMT_INSTALMENT": 30.0, "AMT_PAYMENT": 30.0},
            {"SK_ID_PREV": 11, "DAYS_INSTALMENT": -9.0, "DAYS_ENTRY_PAYMENT": -8.0},
            {"SK_ID_PREV": 99, "DAYS_INSTALMENT": -9.0, "DAYS_ENTRY_PAYMENT": -8.0},
        ],
    )
    result = previous_applications.features(previous, payments)
    assert result.columns == previous_applications.COLUMNS
    one, two = (by_client(result)[i] for i in (1, 2))
    assert one.PREV_NAME_CONTRACT_STATUS_Approved_MEAN == pytest.approx(2 / 3)
    assert two.PREV_NAME_CONTRACT_STATUS_Approved_MEAN == 1.0  # unknown status is skipped
    assert one["PREV_CHANNEL_TYPE_Regional / Local_MEAN"] == 1.0
    assert two["PREV_NAME_TYPE_SUITE_Spouse, partner_MEAN"] == 1.0
    assert one.PREV_SK_ID_PREV_NUNIQUE == 3 and one.APPROVED_SK_ID_PREV_NUNIQUE == 2
    assert one.PREV_APPLICATION_CREDIT_RATIO_MAX == 0.8  # no ratio for a zero credit
    # Active loans: approved and not yet due for the last time.
    assert one.PREV_ACTIVE_SK_ID_PREV_NUNIQUE == 1
    assert one.PREV_ACTIVE_INSTALMENT_PAYMENT_DIFF_MEAN == 10.0
    assert one.PREV_ACTIVE_REMAINING_DEBT_SUM == 50.0
    assert one.TOTAL_REPAYMENT_RATIO == 0.5
    assert two.PREV_ACTIVE_AMT_CREDIT_SUM == 10.0 and two.TOTAL_REPAYMENT_RATIO is None
    # The sentinel stays in the approved segment and is removed elsewhere.
    assert one.APPROVED_DAYS_FIRST_DUE_MEAN == (sentinel - 300) / 2
    assert one.APPROVED_DAYS_LAST_DUE_DIFF_MIN == 0.0
    assert one.PREV_LATE_DAYS_LAST_DUE_1ST_VERSION_MEAN == -40.0
    assert one.PREV_LATE_DAYS_DECISION_MAX == -500 and two.PREV_LATE_DAYS_DECISION_MAX is None
    assert one.PREV_Cash_AMT_CREDIT_SUM == 150.0 and one.PREV_Consumer_AMT_CREDIT_SUM is None
    assert one.PREV_LAST12M_AMT_CREDIT_SUM == 100.0 and one.PREV_LAST24M_AMT_CREDIT_SUM == 150.0
    assert one.PREV_ACTIVE_SIMPLE_INTERESTS_MEAN == pytest.approx(0.1)
    assert (one.REFUSED_DAYS_DECISION_MIN, two.REFUSED_DAYS_DECISION_MIN) == (-900, None)

    cleaned = by_client(
        previous_applications.features(previous, payments, approved_as_recorded=False)
    )
    assert cleaned[1].APPROVED_DAYS_FIRST_DUE_MEAN == -300.0
    assert cleaned[1].PREV_ACTIVE_SK_ID_PREV_NUNIQUE == 1


def test_wide_plans_share_one_wide_aggregation(spark, capsys):
    """All segments of a table are computed by one aggregation, and nothing leaves the JVM."""
    previous = table(spark, schemas.PREVIOUS_APPLICATION, [{"SK_ID_CURR": 1, "SK_ID_PREV": 1}])
    payments = table(spark, schemas.INSTALLMENTS_PAYMENTS, [{"SK_ID_PREV": 1}])
    spark.conf.set("spark.sql.debug.maxToStringFields", "2000")
    try:
        previous_applications.features(previous, payments).explain()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    plan = capsys.readouterr().out
    aggregates = [line for line in plan.splitlines() if "HashAggregate(" in line]
    assert sum("partial_var_samp" in line for line in aggregates) == 1
    for absent in ("Python", "Cartesian", "NestedLoop", "SortAggregate"):
        assert absent not in plan


def test_latest_loan_does_not_depend_on_partitioning(spark):
    rows = [(1, i, -5, float(i)) for i in range(40)]
    frame = spark.createDataFrame(rows, "SK_ID_CURR int, SK_ID_BUREAU int, DAYS_CREDIT int, x double")
    from creditloom.operators.grouped import latest_value

    for parts in (1, 3, 7):
        picked = latest_value(
            frame.repartition(parts, F.rand(1)), "SK_ID_CURR", "x", ["DAYS_CREDIT", "SK_ID_BUREAU"], "y"
        )
        assert picked.first().y == 39.0
    assert not math.isnan(picked.first().y)


def test_bureau_loans_without_an_id_do_not_count(spark):
    from creditloom import schemas
    from creditloom.plans import bureau

    def loan(**values):
        return tuple(values.get(f.name) for f in schemas.TABLES["bureau"].fields)

    rows = [
        loan(SK_ID_CURR=1, SK_ID_BUREAU=5, DAYS_CREDIT=-9, AMT_CREDIT_SUM=10.0, AMT_CREDIT_MAX_OVERDUE=50.0),
        loan(SK_ID_CURR=1, DAYS_CREDIT=-1, AMT_CREDIT_SUM=10.0, AMT_CREDIT_MAX_OVERDUE=10.0),
    ]
    loans = spark.createDataFrame(rows, schemas.TABLES["bureau"])
    history = spark.createDataFrame([], schemas.TABLES["bureau_balance"])
    row = bureau.features(loans, history).first()
    assert (row.BUREAU_AMT_CREDIT_SUM_SUM, row[bureau.LATEST]) == (10.0, 50.0)


@pytest.mark.parametrize("late_of_top", [1, 3])
def test_late_months_go_to_the_client_of_the_latest_row(spark, late_of_top):
    from creditloom import schemas
    from creditloom.plans import pos_cash

    def month(**values):
        return tuple(values.get(f.name) for f in schemas.TABLES["pos_cash_balance"].fields)

    rows = [month(SK_ID_PREV=3, MONTHS_BALANCE=-2, SK_DPD=1), month(SK_ID_PREV=3, SK_ID_CURR=1, MONTHS_BALANCE=-1, SK_DPD=1)]
    months = spark.createDataFrame(rows, schemas.TABLES["pos_cash_balance"])
    assert pos_cash.features(months, late_of_top=late_of_top).first().LATE_PAYMENT_SUM == 2.0
