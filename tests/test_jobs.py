import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from creditloom import schemas
from creditloom.jobs import JOBS, run_job
from creditloom.plans import application_peers
from creditloom.sources import sinks, snapshots, tables
from creditloom.workload.analogue import credit_table
from creditloom.workload.registry import Tables


@pytest.fixture(scope="module")
def deliveries(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("deliveries"))
    for table in ("pos_cash_balance",):
        rows = credit_table(Tables(spark, SMALL), table)
        for date, part in (("20190101", rows), ("20190102", rows.where("SK_ID_CURR % 2 = 0") if "SK_ID_CURR" in rows.columns else rows)):
            part.coalesce(1).write.option("header", True).csv(f"{folder}/{table}_{date}.csv")
    return folder


@pytest.mark.parametrize("name", ["pos_cash"])
def test_a_table_is_derived_written_exported_and_published(spark, deliveries, tmp_path, name):
    job, out = JOBS[name], str(tmp_path)
    first = run_job(spark, name, deliveries, out, "20190101")
    assert first.columns == list(job.columns)
    lines = [r.value for r in spark.read.text(f"{out}/{name}/export/20190101").collect()]
    assert len(lines) == first.count()
    by_client = {r.SK_ID_CURR: r for r in first.collect()}
    quality = tables.read_run(spark, f"{out}/{name}/quality", "20190101").collect()
    assert {r.column for r in quality} == set(schemas.TABLES["pos_cash_balance"].names)
    assert {(r.rejected, r.rows > 0) for r in quality} == {(0, True)}
    schema = first.schema
    exported = spark.read.schema(schema).csv(f"{out}/{name}/export/20190101")
    for row in exported.limit(50).collect():
        assert tuple(row)[:3] == tuple(by_client[row.SK_ID_CURR])[:3]
    for _ in range(2):
        second = run_job(spark, name, deliveries, out, "20190102")
    published = sinks.read_published(spark, f"{out}/{name}/published")
    clients = {r.SK_ID_CURR: r.run for r in published.select("SK_ID_CURR", "run").collect()}
    newer = {r.SK_ID_CURR for r in second.select("SK_ID_CURR").collect()}
    assert set(clients) == set(by_client) | newer
    assert all(run == (20190102 if client in newer else 20190101) for client, run in clients.items())


def test_jobs_know_their_tables():
    for job in JOBS.values():
        assert set(job.inputs) <= set(schemas.TABLES) and job.columns[0] == job.keys[0]


def test_application_peers_from_both_deliveries(spark, tmp_path):
    """The table of two inputs, keyed by peer group; its second run publishes what changed."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = credit_table(Tables(spark, SMALL), "application")
    missing = [f for f in schemas.APPLICATION_TRAIN if f.name not in rows.columns]
    whole = rows.withColumns({f.name: F.lit(0).cast(f.dataType) for f in missing})
    for date, kept in (("20190101", "true"), ("20190102", "AMT_INCOME_TOTAL % 7 <> 0")):
        for table, part in (("application_train", 0), ("application_test", 1)):
            half = whole.where(f"SK_ID_CURR % 2 = {part}").where(kept)
            half = half if part == 0 else half.drop("TARGET")
            half.write.option("header", True).csv(f"{folder}/{table}_{date}.csv")
    first = run_job(spark, "application_peers", folder, out, "20190101")
    direct = application_peers.features(whole.where("SK_ID_CURR % 2 = 0"), whole.drop("TARGET").where("SK_ID_CURR % 2 = 1"))
    keys = list(application_peers.PEER_KEYS)
    assert {tuple(r[k] for k in keys) for r in first.collect()} == {
        tuple(r[k] for k in keys) for r in direct.collect()
    }
    second = run_job(spark, "application_peers", folder, out, "20190102")
    root = f"{out}/application_peers"
    before = {tuple(r[k] for k in keys): tuple(r) for r in first.collect()}
    after = {tuple(r[k] for k in keys): tuple(r) for r in second.collect()}
    fed = tables.read_run(spark, f"{root}/changes", "20190102").collect()
    want = {k: "changed" if k in before else "inserted" for k, r in after.items() if before.get(k) != r}
    assert {tuple(r[k] for k in keys): r.change for r in fed} == want and want
    assert snapshots.snapshots(spark, f"{root}/published") == ["20190101", "20190102"]
