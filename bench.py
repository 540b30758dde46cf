"""Times the headline queries and prints one line of JSON.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (cores), BENCH_RUNS (timed runs per query, the
median counts), BENCH_BRANCHES=1 to time the branch-and-join plans the feature specs replace, too.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent / "tests")]

from branch_plan import branch_features  # noqa: E402
from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from creditloom import plans, workload  # noqa: E402
from creditloom.operators.relational import group_table  # noqa: E402
from creditloom.session import local_session, tune  # noqa: E402
from creditloom.workload.analogue import credit_table  # noqa: E402
from creditloom.workload.registry import Tables  # noqa: E402

HEADLINE = (
    "features_application_peers",
    "features_bureau",
    "features_credit_card",
    "features_pos_cash",
    "features_instalments",
    "features_previous_applications",
    "feature_assembly",
    "agg_segment_period",
    "agg_median_lower",
    "agg_top3_mean",
    "agg_nunique",
    "agg_two_level",
    "agg_peer_group",
    "join_agg_back",
    "peer_bucket_mean",
    "latest_rows",
    "semi_recent_loans",
    "semi_single_loan_clients",
    "semi_late_loans",
    "stream_tumbling_count",
)


def materialise(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(build: Callable[[], DataFrame], runs: int) -> float:
    """Median seconds to plan and run a query, after one run to warm up."""
    samples = []
    for attempt in range(runs + 1):
        start = time.perf_counter()
        materialise(build())
        if attempt or runs == 0:
            samples.append(time.perf_counter() - start)
    return round(statistics.median(samples), 3)


def branch_plans(t: Tables) -> dict[str, Callable[[], DataFrame]]:
    """The six feature tables as one filtered group-by per segment and aggregate, joined."""

    def peers() -> DataFrame:
        rows = plans.application_peers.row_features(
            plans.application_peers.usable(credit_table(t, "application"))
        ).na.drop(subset=list(plans.application_peers.PEER_KEYS))
        keys, table = list(plans.application_peers.PEER_KEYS), None
        for fn, columns in (
            (F.avg, plans.application_peers.MEANS),
            (F.stddev_samp, plans.application_peers.SPREADS),
            (lambda c: F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {c})"), {"m": "EXT_SOURCES_MEAN"}),
        ):
            for name, column in columns.items():
                part = rows.groupBy(*keys).agg(fn(column).alias(name))
                table = part if table is None else table.join(part, keys)
        return table

    def bureau() -> DataFrame:
        loans = credit_table(t, "bureau").where("SK_ID_BUREAU IS NOT NULL")
        rows = plans.bureau.loan_rows(loans, credit_table(t, "bureau_balance"))
        return branch_features(rows, plans.bureau.SPEC)

    def card() -> DataFrame:
        cards = credit_table(t, "credit_card_balance")
        last = group_table(cards, ["SK_ID_PREV"], {"LAST_MONTH": F.max("MONTHS_BALANCE")})
        rows = plans.credit_card.row_features(cards).join(last, "SK_ID_PREV", "left")
        return branch_features(rows, plans.credit_card.SPEC)

    def pos() -> DataFrame:
        rows = plans.pos_cash.row_features(credit_table(t, "pos_cash_balance"))
        loans = plans.pos_cash.loan_features(rows)
        table = branch_features(rows, plans.pos_cash.SPEC)
        for name in plans.pos_cash.LOAN_SUMS:
            part = loans.groupBy("SK_ID_CURR").agg(F.sum(name).alias(name))
            table = table.join(part, "SK_ID_CURR", "left")
        return table

    def instalments() -> DataFrame:
        rows = plans.instalments.row_features(credit_table(t, "installments_payments"))
        return branch_features(rows, plans.instalments.SPEC)

    def previous() -> DataFrame:
        rows = plans.previous_applications.loan_rows(
            credit_table(t, "previous_application"), credit_table(t, "installments_payments")
        )
        return branch_features(rows, plans.previous_applications.SPEC)

    return {
        "features_application_peers": peers,
        "features_bureau": bureau,
        "features_credit_card": card,
        "features_pos_cash": pos,
        "features_instalments": instalments,
        "features_previous_applications": previous,
    }


def plan_size(df: DataFrame) -> dict[str, int]:
    """Shuffles by key and scans of files in the plan, before any is reused or dropped."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return {"exchanges": text.count("Exchange hashpartitioning"), "scans": text.count("FileScan")}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = tune(local_session(cores=cores, app="bench", spark__sql__shuffle__partitions=cores))
    queries = workload.callables()
    seconds = {name: timed(lambda n=name: queries[n](spark, folder), runs) for name in HEADLINE}
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    report["stream_events_per_sec"] = round(events / seconds["stream_tumbling_count"])
    if os.environ.get("BENCH_BRANCHES", "0") == "1":
        tables = Tables(spark, folder)
        report["branch_and_join"] = {
            name: {
                "one_pass": plan_size(queries[name](spark, folder)),
                "branches": plan_size(build()),
                "branches_sec": timed(build, runs),
            }
            for name, build in branch_plans(tables).items()
        }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
