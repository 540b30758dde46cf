import math

import pytest
from branch_plan import branch_features
from conftest import SMALL

from creditloom.operators.spec import FeatureSpec, Segment, Vocabulary, block, build_features
from creditloom.plans import previous_applications
from creditloom.workload.analogue import credit_table
from creditloom.workload.registry import Tables

ROWS = [
    # client, loan, status, day, amount, label
    (1, 10, "F", -5, 4.0, "x"),
    (1, 11, "F", -400, None, ""),
    (1, 12, None, -20, 2.0, "y"),
    (2, 20, "O", -700, 8.0, None),
    (3, 30, "F", -1, None, None),
    (3, 31, "F", -2, None, ""),
    (None, 40, "F", -1, 100.0, "x"),
]
SCHEMA = "client int, loan int, status string, day int, amount double, label string"
SPEC = FeatureSpec(
    ("client",),
    (
        Segment(
            "ALL_",
            (
                block("mean", "amount", "status_F", "status_O"),
                block("var", "amount"),
                block("nunique", "loan", "label"),
                block("size", "amount"),
            ),
        ),
        Segment(
            "F_",
            (
                block("size", "amount"),
                block("sum", "amount"),
                block("nunique", "label"),
                block("median_lower", "amount"),
                block("top3", "amount"),
                block("max_or_zero", "amount"),
            ),
            rows="status = 'F'",
        ),
        Segment("NEW_", (block("min", "day"), block("size", "loan")), rows="day >= -30"),
        Segment("ONE_", (block("sum", "amount"), block("size", "loan")), group="count(loan) = 1"),
    ),
    vocabularies=(Vocabulary("status", ("F", "O"), null_as_zero=False),),
)


@pytest.fixture(scope="module")
def result(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    return build_features(frame, SPEC)


def test_columns_follow_the_spec(result):
    assert result.columns == SPEC.names()
    assert result.columns[:4] == ["client", "ALL_amount_MEAN", "ALL_status_F_MEAN", "ALL_status_O_MEAN"]


def test_values_of_whole_group_and_empty_segments(result):
    by_client = {row.client: row for row in result.collect()}
    assert sorted(by_client) == [1, 2, 3]  # no row for the unknown client
    first, second, third = by_client[1], by_client[2], by_client[3]
    assert first.ALL_amount_MEAN == 3.0 and first.ALL_amount_VAR == 2.0
    assert (first.ALL_status_F_MEAN, first.ALL_status_O_MEAN) == (1.0, 0.0)  # unknown status skipped
    assert (first.ALL_loan_NUNIQUE, first.ALL_label_NUNIQUE) == (3, 2)  # empty text not counted
    assert second.ALL_amount_VAR is None  # one value has no variance
    assert (third.ALL_amount_SIZE, third.ALL_label_NUNIQUE) == (0, 0)
    assert third.ALL_amount_MEAN is None

    # A segment without rows gives NULL throughout, counts included.
    assert all(second[n] is None for n in result.columns if n.startswith(("F_", "NEW_")))
    # A segment with rows but without values gives 0 where the aggregate says so.
    assert (third.F_amount_SIZE, third.F_amount_SUM, third.F_label_NUNIQUE) == (0, None, 0)
    assert (third.F_amount_MEDIAN, third.F_amount_TOP3, third.F_amount_MAX) == (0.0, 0.0, 0.0)
    assert (first.F_amount_SIZE, first.F_amount_MEDIAN, first.F_amount_MAX) == (1, 4.0, 4.0)
    assert (first.NEW_day_MIN, first.NEW_loan_SIZE) == (-20, 2)

    # A group predicate keeps all rows of the group or none.
    assert (first.ONE_amount_SUM, first.ONE_loan_SIZE) == (None, None)
    assert (second.ONE_amount_SUM, second.ONE_loan_SIZE) == (8.0, 1)


def test_unknown_aggregate_is_named(spark):
    spec = FeatureSpec(("client",), (Segment("X_", (block("mode", "amount"),)),))
    with pytest.raises(KeyError, match="mode"):
        build_features(spark.createDataFrame(ROWS, SCHEMA), spec)


def test_spec_of_distinct_features_only(spark):
    spec = FeatureSpec(("client",), (Segment("X_", (block("nunique", "status"),)),))
    result = build_features(spark.createDataFrame(ROWS, SCHEMA), spec)
    assert {r.client: r.X_status_NUNIQUE for r in result.collect()} == {1: 1, 2: 1, 3: 1}


def test_two_keys_and_null_in_either(spark):
    rows = [(1, "a", 1.0), (1, "b", 2.0), (1, None, 9.0), (None, "a", 9.0), (1, "a", 3.0)]
    spec = FeatureSpec(("k", "l"), (Segment("", (block("sum", "v"), block("nunique", "v"))),))
    result = build_features(spark.createDataFrame(rows, "k int, l string, v double"), spec)
    assert sorted(map(tuple, result.collect())) == [(1, "a", 4.0, 2), (1, "b", 2.0, 1)]


def same(left, right):
    if isinstance(left, float) and isinstance(right, float):
        return math.isclose(left, right, rel_tol=1e-9, abs_tol=1e-9)
    return left == right


@pytest.mark.parametrize("name", ["bureau", "credit_card", "pos_cash", "instalments", "previous_applications"])
def test_fused_plan_equals_branches(spark, name):
    """The published specs give the same features as one group-by per segment and aggregate."""
    from conftest import SMALL
    from creditloom import plans
    from creditloom.session import cut_lineage
    from creditloom.workload.analogue import credit_table
    from creditloom.workload.registry import Tables

    tables = Tables(spark, SMALL)
    plan = getattr(plans, name)
    if name == "bureau":
        rows = plan.loan_rows(credit_table(tables, "bureau"), credit_table(tables, "bureau_balance"))
    elif name == "credit_card":
        cards = credit_table(tables, "credit_card_balance")
        last = cards.groupBy("SK_ID_PREV").agg({"MONTHS_BALANCE": "max"})
        last = last.withColumnRenamed("max(MONTHS_BALANCE)", "LAST_MONTH")
        rows = plan.row_features(cards).join(last, "SK_ID_PREV", "left")
    elif name == "pos_cash":
        rows = plan.row_features(credit_table(tables, "pos_cash_balance"))
    elif name == "instalments":
        rows = plan.row_features(credit_table(tables, "installments_payments"))
    else:
        rows = plan.loan_rows(
            credit_table(tables, "previous_application"),
            credit_table(tables, "installments_payments"),
        )
    rows = cut_lineage(rows)
    fused = {r[0]: r for r in build_features(rows, plan.SPEC).collect()}
    # Segment by segment, to keep the branch plans small.
    for segment in plan.SPEC.segments:
        part = FeatureSpec(plan.SPEC.keys, (segment,), plan.SPEC.vocabularies)
        branches = branch_features(rows, part).collect()
        present = set()
        for branch in branches:
            present.add(branch[0])
            for column in part.names():
                assert same(branch[column], fused[branch[0]][column]), (column, branch[0])
        for client, row in fused.items():
            if client not in present:
                assert all(row[f.name] is None for f in part.features())


@pytest.mark.parametrize("hot_rows", [10**9, 4])
def test_wide_specs_survive_a_hot_client(spark, capsys, hot_rows):
    """A third of all rows on one client: its rows are dealt out, the features stay the same."""
    columns = [f"c{i}" for i in range(20)]
    frame = spark.range(300).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS client",
        *(f"CAST((id * {7 + i}) % 101 AS DOUBLE) AS {c}" for i, c in enumerate(columns)),
    )
    blocks = tuple(block(fn, *columns) for fn in ("mean", "max", "min", "sum"))
    spec = FeatureSpec(("client",), (Segment("X_", (*blocks, block("nunique", "c0"))),))
    result = build_features(frame, spec, hot_rows=hot_rows)
    result.explain()
    assert ("LeftAnti" in capsys.readouterr().out) is (hot_rows == 4)
    fused = {r.client: r for r in result.collect()}
    branches = branch_features(frame, spec).collect()
    assert len(fused) == len(branches) == frame.select("client").distinct().count()
    for branch in branches:
        assert all(same(branch[c], fused[branch.client][c]) for c in spec.names())


def test_equal_rows_of_a_hot_key_stay_spread(spark):
    from pyspark.sql import functions as F

    from creditloom.operators.spec import cluster_by_key

    rows = spark.range(2000, numPartitions=4).select(F.lit(1).alias("k"), F.lit(2.0).alias("v"))
    dealt = cluster_by_key(rows, ["k"], rows, hot_rows=100)
    counts = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 2000 and max(counts) <= 500


def test_clustering_can_be_left_out(spark, capsys):
    blocks = (block("mean", *(f"c{i}" for i in range(70))),)
    frame = spark.range(10).selectExpr("id AS k", *(f"id AS c{i}" for i in range(70)))
    spec = FeatureSpec(("k",), (Segment("", blocks),))
    for bound, clustered in ((64, True), (None, False), (71, False)):
        build_features(frame, spec, cluster_from=bound).explain()
        assert ("REPARTITION_BY_COL" in capsys.readouterr().out) is clustered


def test_known_keys_are_not_counted(spark):
    """With ``hot_rows=None`` building the plan starts no job, and the rows are the same."""
    tables = Tables(spark, SMALL)
    previous, payments = (
        credit_table(tables, name) for name in ("previous_application", "installments_payments")
    )
    tracker = spark.sparkContext.statusTracker()
    found = {}
    for bound in (None, 5_000_000):
        spark.sparkContext.setJobGroup(f"bound {bound}", "plans")
        found[bound] = previous_applications.features(previous, payments, hot_rows=bound)
        assert (len(tracker.getJobIdsForGroup(f"bound {bound}")) == 0) is (bound is None)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    rows = [sorted(str(r.SK_ID_CURR) for r in f.select("SK_ID_CURR").collect()) for f in found.values()]
    assert rows[0] == rows[1]


def test_names_must_differ():
    with pytest.raises(ValueError, match="X_v_MEAN"):
        FeatureSpec(("k",), (Segment("X_", (block("mean", "v"),)), Segment("X_", (block("mean", "v"),), rows="f")))
    with pytest.raises(ValueError, match="v_MEAN"):
        FeatureSpec(("v_MEAN",), (Segment("", (block("mean", "v"),)),))


def test_segments_may_share_a_prefix(spark):
    rows = [(1, 0, 4.0), (2, 1, 9.0)]
    spec = FeatureSpec(
        ("k",),
        (
            Segment("X_", (block("nunique", "v"),), rows="f = 1"),
            Segment("X_", (block("median_lower", "v"),), rows="f = 0"),
        ),
    )
    result = build_features(spark.createDataFrame(rows, "k int, f int, v double"), spec)
    assert {r.k: (r.X_v_NUNIQUE, r.X_v_MEDIAN) for r in result.collect()} == {1: (None, 4.0), 2: (1, None)}


def test_registered_aggregates_are_dispatched(spark):
    from pyspark.sql import functions as F

    from creditloom.functions.aggregates import Aggregate, register

    def second(rows, keys, column, out):
        return rows.groupBy(*keys).agg(F.get(F.sort_array(F.collect_list(column), False), F.lit(1)).alias(out))

    register("test_second", Aggregate("SECOND", execution="ranked", operator=second))
    spec = FeatureSpec(("k",), (Segment("", (block("test_second", "v"),)),))
    frame = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 9.0)], "k int, v double")
    assert build_features(frame, spec).first().v_SECOND == 2.0
    for wrong in ({"execution": "ranked"}, {"execution": "sorted", "sql": "max({})"}, {}):
        with pytest.raises(ValueError):
            Aggregate("X", **wrong)
