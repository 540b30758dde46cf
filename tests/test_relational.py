import pytest
from pyspark.sql import functions as F

from creditloom.operators import relational as r
from creditloom.session import cut_lineage


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_group_totals_skip_null_keys(spark):
    frame = spark.createDataFrame(
        [(1, 1, 5.0), (1, 1, 7.0), (1, 2, 1.0), (None, 1, 9.0), (1, None, 4.0)],
        "loan int, number int, paid double",
    )
    result = r.with_group_total(frame, ["loan", "number"], {"total": F.sum("paid")})
    totals = {(x.loan, x.number, x.paid): x.total for x in result.collect()}
    assert totals == {
        (1, 1, 5.0): 12.0,
        (1, 1, 7.0): 12.0,
        (1, 2, 1.0): 1.0,
        (None, 1, 9.0): None,
        (1, None, 4.0): None,
    }


@pytest.mark.parametrize("limit", [100, 0])
def test_peer_means_with_and_without_broadcast(spark, capsys, limit):
    frame = spark.createDataFrame(
        [(1, 3, 10.0), (2, 3, 20.0), (3, None, 99.0), (4, 5, None)], "id int, bucket long, x double"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = r.with_peer_means(frame, "bucket", ["x"], "peer_", broadcast_rows=limit)
        result.explain()
        assert ("BroadcastHashJoin" in capsys.readouterr().out) is (limit > 0)
        assert {x.id: x.peer_x for x in result.collect()} == {1: 15.0, 2: 15.0, 3: None, 4: None}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latest_rows_keep_ties_and_drop_unknown(spark):
    frame = spark.createDataFrame(
        [(1, -3, "a"), (1, -1, "b"), (1, -1, "c"), (2, None, "d"), (None, -1, "e"), (3, -9, "f")],
        "loan int, month int, x string",
    )
    assert sorted(x.x for x in r.latest_rows(frame, "loan", "month").collect()) == ["b", "c", "f"]


def test_activity_keeps_old_rows_of_active_loans(spark):
    frame = spark.createDataFrame(
        [(1, -2, "new"), (1, -40, "old"), (2, -12, "edge"), (3, -50, "idle"), (None, -1, "none")],
        "loan int, month int, x string",
    )
    kept = sorted(x.x for x in r.with_activity_in(frame, "loan", "month", 12).collect())
    assert kept == ["new", "old"]
    kept = sorted(
        x.x for x in r.with_activity_in(frame, "loan", "month", 12, inclusive=True).collect()
    )
    assert kept == ["edge", "new", "old"]


def test_single_member_counts_only_the_period(spark):
    frame = spark.createDataFrame(
        [
            (1, 10, -5.0),  # one loan in the period, another one before it
            (1, 10, -9.0),
            (1, 11, -5000.0),
            (2, 20, -5.0),  # two loans in the period
            (2, 21, -6.0),
            (3, 30, -5000.0),  # none in the period
            (4, None, -5.0),  # the loan is unknown
        ],
        "client int, loan int, day double",
    )
    kept = rows(r.with_single_member_in(frame, "client", "loan", "day", 1080).select("loan", "day"))
    assert kept == [(10, -5.0), (10, -9.0), (11, -5000.0)]


def test_with_event_does_not_multiply_rows(spark):
    loans = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "loan int, x string")
    paid = spark.createDataFrame([(1, 5), (1, 6), (2, -1), (9, 7), (None, 8)], "loan int, late int")
    assert rows(r.with_event(loans, paid, "loan", F.col("late") > 0)) == [(1, "a")]


def test_union_matches_names_not_positions(spark):
    left = spark.createDataFrame([(1, "a")], "id int, x string")
    right = spark.createDataFrame([("b", 2), ("a", 1)], "x string, id int")
    assert rows(r.union_all(left, right)) == [(1, "a"), (1, "a"), (2, "b")]


def test_sum_all_numeric_and_two_level(spark):
    frame = spark.createDataFrame(
        [(1, 10, 1.5, "x"), (1, 11, 2.5, "y"), (2, 12, None, "z")], "k int, a int, b double, c string"
    )
    summed = r.sum_all_numeric(frame, ["k"], "_SUM")
    assert summed.columns == ["k", "a_SUM", "b_SUM"]
    assert rows(summed) == [(1, 21, 4.0), (2, 12, None)]
    result = r.two_level(frame, ["k", "a"], {"m": F.max("b")}, ["k"], {"s": F.sum("m")})
    assert rows(result) == [(1, 4.0), (2, None)]


def test_a_hot_loan_is_split_across_tasks(spark, capsys):
    """A third of all rows on one key: the join back to its group is split at run time."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    try:
        frame = cut_lineage(
            spark.range(60_000, numPartitions=12).selectExpr(
                "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS loan",
                "CAST(-(id % 60) AS INT) AS month",
                "uuid() AS payload",
            )
        )
        joined = r.with_group_total(frame, ["loan"], {"last": F.max("month")})
        counted = joined.groupBy("last").agg(F.count("loan").alias("n"), F.max("payload"))
        assert sum(x.n for x in counted.collect()) == 60_000
        counted.explain()
        assert "skew=true" in capsys.readouterr().out
    finally:
        for name in (
            "spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        ):
            spark.conf.unset(name)


def test_broadcast_looks_at_rows_and_bytes(spark):
    from creditloom.operators.relational import broadcast_if_small

    table = cut_lineage(spark.range(100).selectExpr("id", "repeat('x', 100) AS s"))
    hinted = lambda **limits: "broadcast" in broadcast_if_small(table, **limits)._jdf.queryExecution().logical().toString().lower()
    assert hinted() and not hinted(rows=99) and not hinted(size=10_000)
    assert broadcast_if_small(table.where("id < 0")).count() == 0


def test_peer_means_run_their_input_once(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 7 AS bucket", "double(id) AS x").write.parquet(f"{tmp_path}/source")
    frame = spark.read.parquet(f"{tmp_path}/source").where("id > 3")
    result = r.with_peer_means(frame, "bucket", ["x"], "peer_")
    assert not any("/source/" in file for file in result.inputFiles())
    assert result.count() == 96
    again = r.with_peer_means(frame, "bucket", ["x"], "peer_", stored=True)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, result.collect()))


def test_pruned_semi_joins_filter_the_scan_ahead_of_the_shuffle(spark, tmp_path):
    """At sizes where the key side is not broadcast, a Bloom filter of it reaches the large scan."""
    spark.range(20_000).selectExpr("id % 500 AS k", "id AS x", "-int(id % 90) AS month").write.parquet(f"{tmp_path}/rows")
    spark.range(500).selectExpr("id AS k", "double(id) AS late").write.parquet(f"{tmp_path}/events")
    rows, events = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("rows", "events"))
    size = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    spark.conf.set(size, "1k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for make in (
            lambda prune: r.with_event(rows, events, "k", F.col("late") > 480, prune=prune),
            lambda prune: r.with_activity_in(rows, "k", "month", 2, prune=prune),
        ):
            pruned, grouped = make(True), make(False)
            plan = pruned._jdf.queryExecution().executedPlan().toString()
            assert "might_contain" in plan
            filters = [at for at, line in enumerate(plan.splitlines()) if "might_contain" in line]
            exchanges = [at for at, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning(k" in line]
            assert min(exchanges) < filters[0]
            assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, grouped.collect()))
    finally:
        spark.conf.unset(size)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
