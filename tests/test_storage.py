from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Observation
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from creditloom import schemas
from creditloom.sources import sinks, snapshots, tables


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def write(path, text):
    with open(path, "w") as file:
        file.write(text)


def test_csv_columns_are_found_by_name(spark, folder):
    write(
        f"{folder}/bureau_balance_20190101.csv",
        "EXTRA,STATUS,SK_ID_BUREAU,MONTHS_BALANCE\nq,C,7,-3\nq,0,8,oops\nq,,9,\n",
    )
    frame = tables.read_run_csv(spark, folder, "bureau_balance", "20190101")
    assert frame.schema == schemas.BUREAU_BALANCE
    assert sorted(map(tuple, frame.collect())) == [(7, -3, "C"), (8, None, "0"), (9, None, None)]


def test_csv_by_position_and_missing_column(spark, folder):
    write(f"{folder}/x.csv", "a,b,c\n7,-3,C\n")
    frame = tables.read_csv(spark, f"{folder}/x.csv", schemas.BUREAU_BALANCE, by_position=True)
    assert [tuple(r) for r in frame.collect()] == [(7, -3, "C")]
    with pytest.raises(ValueError, match="STATUS"):
        tables.read_csv(spark, f"{folder}/x.csv", schemas.BUREAU_BALANCE)


def test_a_repeated_run_replaces_only_itself(spark, folder):
    path = f"{folder}/features"
    sinks.write_run(spark.range(5), path, "20190101")
    sinks.write_run(spark.range(3), path, "20190102")
    for _ in range(2):
        sinks.write_run(spark.range(10, 12), path, "20190101")
    assert sorted(r.id for r in tables.read_run(spark, path, "20190101").collect()) == [10, 11]
    assert tables.read_run(spark, path, "20190102").count() == 3


def test_reading_a_run_prunes_the_other_partitions(spark, folder, capsys):
    path = f"{folder}/features"
    sinks.write_run(spark.range(5), path, "20190101")
    tables.read_run(spark, path, "20190101").explain("formatted")
    assert "PartitionFilters: [isnotnull(run_date" in capsys.readouterr().out


def test_export_has_no_header_and_keeps_column_order(spark, folder):
    frame = spark.createDataFrame([(1, None, "x")], "b int, a double, c string")
    sinks.export_csv(frame, f"{folder}/out", single_file=True)
    assert spark.read.text(f"{folder}/out").first().value == "1,,x"


def test_snapshots_merge_and_repeat(spark, folder):
    root = f"{folder}/published"
    schema = "k int, x string, version int"
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 5), (3, "c", 1)], schema)
    second = spark.createDataFrame([(1, "A", 2), (2, "stale", 4), (3, "C", 1), (4, "D", 2)], schema)
    sinks.publish(first, root, ["k"], "version", snapshot="1")
    for _ in range(2):
        sinks.publish(second, root, ["k"], "version", snapshot="2")
    rows = sinks.read_published(spark, root).collect()
    assert sorted((r.k, r.x) for r in rows) == [(1, "A"), (2, "b"), (3, "C"), (4, "D")]
    before = sinks.read_published(spark, root, "1").collect()
    assert sorted((r.k, r.x) for r in before) == [(1, "a"), (2, "b"), (3, "c")]
    with pytest.raises(ValueError, match="nothing"):
        sinks.read_published(spark, f"{folder}/elsewhere")


def test_a_batch_is_merged_with_itself_and_ties_are_definite(spark, folder):
    schema = "k int, x string, version int"
    batch = [(1, "old", 1), (1, "new", 2), (2, "p", 3), (2, "q", 3)]
    seen = set()
    for i, rows in enumerate((batch, batch[::-1])):
        root = f"{folder}/published{i}"
        frame = spark.createDataFrame(rows, schema).repartition(3 - i)
        sinks.publish(frame, root, ["k"], "version", snapshot="1")
        seen.add(tuple(sorted((r.k, r.x) for r in sinks.read_published(spark, root).collect())))
    assert len(seen) == 1 and seen.pop()[0] == (1, "new")


def test_only_the_buckets_of_a_batch_are_written(spark, folder):
    import os

    root = f"{folder}/published"
    frame = spark.range(200).selectExpr("id AS k", "1 AS version")
    sinks.publish(frame, root, ["k"], "version", snapshot="1", buckets=16)
    sinks.publish(frame.where("k = 7").withColumn("version", frame.version + 1), root, ["k"], "version", snapshot="2", buckets=16)
    second = [d for d in os.listdir(root) if os.path.exists(f"{root}/{d}/snapshot=2")]
    assert len(second) == 1
    assert sinks.read_published(spark, root).agg({"version": "sum"}).first()[0] == 201


def test_every_file_has_its_own_header(spark, folder):
    write(f"{folder}/a.csv", "id,x\n1,10\n")
    write(f"{folder}/b.csv", "x,id\n20,2\n")
    write(f"{folder}/c.csv", "id,y,x\n3,z,30\n")
    schema = StructType([StructField("id", LongType()), StructField("x", LongType())])
    frame = tables.read_csv(spark, folder, schema)
    assert sorted(map(tuple, frame.collect())) == [(1, 10), (2, 20), (3, 30)]
    write(f"{folder}/d.csv", "id,x\n4,oops\n")
    assert (4, None) in map(tuple, tables.read_csv(spark, folder, schema).collect())
    with pytest.raises(Exception, match="oops|MALFORMED"):
        tables.read_csv(spark, folder, schema, strict=True).collect()


def test_filters_and_columns_reach_the_scan(spark, capsys):
    from conftest import SMALL
    from creditloom import workload

    workload.callables()["filter_column_expr"](spark, SMALL).explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(o_orderstatus,O)" in plan
    assert "o_orderdate" not in plan.split("ReadSchema")[1]


def test_a_delivery_is_written_by_all_its_partitions(spark):
    from types import SimpleNamespace

    from creditloom.workload import storage

    customer = spark.range(0, 400, 1, 4).selectExpr(
        "id AS c_custkey", "'x' AS c_mktsegment", "1.5D AS c_acctbal"
    )
    frame = storage.src_csv_scan(SimpleNamespace(spark=spark, customer=customer))
    assert len(frame.inputFiles()) == 8
    assert sorted(r.c_custkey for r in frame.collect()) == list(range(400))


def rows_of(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=str)


def test_fifty_snapshots_are_read_by_manifest_and_old_ones_go(spark, folder):
    root = f"{folder}/published"
    frame = spark.range(40).selectExpr("id AS k", "id AS x", "0 AS version")
    snapshots.publish(frame, root, ["k"], "version", snapshot="00", buckets=8)
    for n in range(1, 51):
        one = spark.createDataFrame([(n % 40, 100 + n, n)], "k long, x long, version int")
        found = snapshots.publish(one, root, ["k"], "version", snapshot=f"{n:02}")
        assert len(found.current) == 8
    want = {k: 100 + max((n for n in range(1, 51) if n % 40 == k), default=0) for k in range(40)}
    want = {k: x if x > 100 else k for k, x in want.items()}
    now = snapshots.read_published(spark, root)
    assert {r.k: r.x for r in now.collect()} == want
    opened = {f.split("/published/")[1].rsplit("/", 1)[0] for f in now.inputFiles()}
    named = {f"key_bucket={b}/snapshot={f}" for b, f in found.current.items()}
    assert opened == named and len(opened) == 8
    tenth = rows_of(snapshots.read_published(spark, root, "45"), "k", "x")
    dropped = snapshots.retain(spark, root, 6)
    assert dropped == [f"{n:02}" for n in range(45)]
    assert snapshots.snapshots(spark, root) == [f"{n:02}" for n in range(45, 51)]
    assert rows_of(snapshots.read_published(spark, root, "45"), "k", "x") == tenth
    assert {r.k: r.x for r in snapshots.read_published(spark, root).collect()} == want
    stored = {str(p.relative_to(root)) for p in Path(root).glob("key_bucket=*/snapshot=*")}
    assert len(stored) <= 8 + 5
    with pytest.raises(ValueError, match="nothing"):
        snapshots.read_published(spark, root, "44")


def test_a_failed_publish_is_not_seen(spark, folder, monkeypatch):
    root = f"{folder}/published"
    first = spark.createDataFrame([(1, "a", 1)], "k int, x string, version int")
    snapshots.publish(first, root, ["k"], "version", snapshot="1")

    def fail(*_):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "_put", fail)
        with pytest.raises(OSError):
            snapshots.publish(first.withColumn("x", F.lit("b")), root, ["k"], "version", snapshot="2")
    assert rows_of(snapshots.read_published(spark, root), "k", "x") == [(1, "a")]
    snapshots.publish(first.withColumn("x", F.lit("c")), root, ["k"], "version", snapshot="2")
    assert rows_of(snapshots.read_published(spark, root), "k", "x") == [(1, "c")]


def test_a_repeated_run_leaves_later_snapshots_alone(spark, folder):
    root, schema = f"{folder}/published", "k int, x string, version int"
    for name, x in (("1", "a"), ("2", "b"), ("1", "A"), ("1", "AA")):
        k = 1 if name == "1" else 2
        frame = spark.createDataFrame([(k, x, int(name))], schema)
        snapshots.publish(frame, root, ["k"], "version", snapshot=name, buckets=1)
    assert rows_of(snapshots.read_published(spark, root, "1"), "k", "x") == [(1, "AA")]
    assert rows_of(snapshots.read_published(spark, root, "2"), "k", "x") == [(1, "a"), (2, "b")]


def test_full_snapshots_remove_and_buckets_grow(spark, folder):
    root, schema = f"{folder}/published", "k int, x string, version int"
    first = spark.createDataFrame([(k, f"x{k}", 1) for k in range(30)], schema)
    second = first.where("k % 3 > 0").withColumn("version", F.lit(2))
    snapshots.publish(first, root, ["k"], "version", snapshot="1", buckets=4)
    snapshots.publish(second, root, ["k"], "version", snapshot="2", buckets=4, full=True)
    assert rows_of(snapshots.read_published(spark, root), "k") == rows_of(second, "k")
    wider = snapshots.rebucket(spark, root, snapshot="3", buckets=9)
    assert wider.buckets == 9 and len(wider.current) > 4
    assert rows_of(snapshots.read_published(spark, root), "k", "x") == rows_of(second, "k", "x")
    fed = rows_of(snapshots.changed_keys(spark, root, "1", "3"), "k", "change")
    assert fed == sorted([(k, "removed") for k in range(0, 30, 3)], key=str)
    assert snapshots.changed_keys(spark, root, "2", "3").isEmpty()
    with pytest.raises(ValueError, match="other columns"):
        snapshots.publish(second.drop("x"), root, ["k"], "version", snapshot="4")
    with pytest.raises(ValueError, match="published by"):
        snapshots.publish(second, root, ["x"], "version", snapshot="4")
    snapshots.publish(second.limit(0), root, ["k"], "version", snapshot="5", full=True)
    assert snapshots.read_published(spark, root).isEmpty()


def test_changes_read_keys_and_digests_of_touched_buckets(spark, folder, capsys):
    root, schema = f"{folder}/published", "k int, l string, x double, y string, version int"
    first = spark.createDataFrame(
        [(k, f"l{k}", float(k), None if k % 2 else "y", 1) for k in range(60)]
        + [(None, None, None, None, 1), (None, "n", 1.0, None, 1)],
        schema,
    )
    batch = [(1, "l1", 1.0, None, 2), (2, "l2", None, "y", 2), (None, "n", 1.0, "", 2), (99, "new", 0.0, "", 2)]
    snapshots.publish(first, root, ["k", "l"], "version", snapshot="a", buckets=32)
    snapshots.publish(spark.createDataFrame(batch, schema), root, ["k", "l"], "version", snapshot="b")
    fed = snapshots.changes(spark, root, "a", "b")
    assert fed.columns == ["k", "l", "change", "x", "y", "version"]
    assert rows_of(fed, "k", "l", "change", "x", "y") == sorted(
        [
            (2, "l2", "changed", None, "y"),
            (99, "new", "inserted", 0.0, ""),
            (None, "n", "changed", 1.0, ""),
        ],
        key=str,
    )
    back = rows_of(snapshots.changes(spark, root, "b", "a"), "k", "l", "change", "x")
    assert ((99, "new", "removed", None)) in back and len(back) == 3
    keys = snapshots.changed_keys(spark, root, "a", "b")
    assert len(keys.inputFiles()) <= 2 * 4 * 2
    keys.explain("formatted")
    plan = capsys.readouterr().out
    assert "x:double" not in plan and "SortAggregate" not in plan
    with pytest.raises(ValueError, match="no snapshot"):
        snapshots.changes(spark, root, "a", "c")


def count_jobs(spark, action):
    """How many Spark jobs an action starts."""
    tracker = spark.sparkContext.statusTracker()
    group = f"group {action}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        action()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_one_job_finds_all_headers(spark, folder):
    for i in range(40):
        names = ["id", "x", f"extra{i % 3}"]
        order = names[i % 3 :] + names[: i % 3]
        lines = [",".join(order)] + [",".join({"id": str(i), "x": str(k)}.get(n, "e") for n in order) for k in range(3)]
        write(f"{folder}/{i}.csv", "\n" * (i % 2) + "\n".join(lines) + "\n")
    write(f"{folder}/empty.csv", "")
    write(f"{folder}/blank.csv", "\n  \n")
    assert count_jobs(spark, lambda: tables.layouts_of(spark, folder)) <= 2  # and one that lists files
    found = tables.layouts_of(spark, folder)
    assert sum(map(len, found.values())) == 40
    schema = StructType([StructField("id", LongType()), StructField("x", LongType())])
    got = tables.read_csv(spark, folder, schema)
    assert rows_of(got, "id", "x") == sorted([(i, k) for i in range(40) for k in range(3)], key=str)


def test_headers_of_large_files_come_from_their_first_block(spark, folder):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        for name in ("a", "b"):
            write(f"{folder}/{name}.csv", f"id,{name}\n" + "".join(f"{k},{k * 2}\n" for k in range(3000)))
        found = {header for header in tables.layouts_of(spark, folder)}
        assert found == {("id", "a"), ("id", "b")}
        schema = StructType([StructField("id", LongType())])
        assert tables.read_csv(spark, folder, schema).count() == 6000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_first_lines_are_kept_by_hash(spark, folder, capsys, monkeypatch):
    write(f"{folder}/a.csv", "id\n1\n")
    plans, collect = [], type(spark.range(1)).collect
    monkeypatch.setattr(
        type(spark.range(1)),
        "collect",
        lambda self: plans.append(self._jdf.queryExecution().executedPlan().toString()) or collect(self),
    )
    tables.first_lines(spark, folder)
    assert "ObjectHashAggregate" in plans[0] and "SortAggregate" not in plans[0]


def test_a_common_header_needs_no_search(spark, folder):
    for name in "ab":
        write(f"{folder}/{name}.csv", "id,x\n1,2\n")
    schema = StructType([StructField("x", LongType())])
    assert tables.read_csv(spark, folder, schema, same_header=True).count() == 2
    write(f"{folder}/c.csv", "x,id\n1,2\n")
    with pytest.raises(Exception, match="header|Header"):
        tables.read_csv(spark, folder, schema, same_header=True).collect()


def test_types_are_the_narrowest_that_take_all_files(spark, folder):
    write(
        f"{folder}/a.csv",
        "i,l,d,day,moment,flag,text,none,mix\n"
        "1,5000000000,1.5,2019-01-01,2019-01-01 10:00:00,true,x,,1\n"
        "-7,1,2,2019-12-31,2019-01-02T11:30:00,FALSE,,,2019-01-01\n",
    )
    write(f"{folder}/b.csv", "mix,l,i,d,moment,late\ntrue,3,4,1e3,2019-05-05,99999999999999999999\n")
    found = {f.name: f.dataType.simpleString() for f in tables.infer_schema(spark, folder)}
    assert found == {
        "i": "int", "l": "bigint", "d": "double", "day": "date", "moment": "timestamp",
        "flag": "boolean", "text": "string", "none": "string", "mix": "string", "late": "double",
    }
    rows = tables.read_csv(spark, folder)
    assert dict(rows.dtypes) == found
    assert rows.where("i = 4").first().late == 1e20 and rows.where("day IS NULL").count() == 1
    write(f"{folder}/c/only.csv".replace("/c/", "/"), "i\n2147483648\n")
    assert dict(tables.read_csv(spark, folder).dtypes)["i"] == "bigint"
    empty = f"{folder}/nothing"
    Path(empty).mkdir()
    write(f"{empty}/a.csv", "")
    assert tables.infer_schema(spark, empty) == StructType([])


def test_rejected_values_are_counted_in_the_same_pass(spark, folder):
    write(f"{folder}/a.csv", "id,x,note\n1,2,n\noops,,n\n3,1.5e,\"a, b\"\n4\n")
    write(f"{folder}/b.csv", "x,id\nbad,worse\n,7\n")
    schema = StructType([StructField("id", LongType()), StructField("x", DoubleType())])
    seen = Observation()
    rows = tables.read_csv(spark, folder, schema, observed=seen)
    assert rows.columns == ["id", "x"]
    got = rows_of(rows, "id", "x")
    assert got == rows_of(tables.read_csv(spark, folder, schema), "id", "x")
    assert seen.get == {"rows": 6, "id": 2, "x": 2}
