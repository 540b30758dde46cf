"""Applications: statistics of peer groups (organisation, education, occupation, gender, age)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.scalar import (
    age_band,
    row_max,
    row_mean,
    row_median,
    row_min,
    row_product,
    row_var_pop,
    row_weighted_sum,
    safe_ratio,
)
from creditloom.functions.vocabulary import DAYS_SENTINEL
from creditloom.operators.grouped import HOT_GROUP_ROWS, group_median
from creditloom.operators.relational import union_all

PEER_KEYS = (
    "ORGANIZATION_TYPE",
    "NAME_EDUCATION_TYPE",
    "OCCUPATION_TYPE",
    "CODE_GENDER",
    "AGE_RANGE",
)
SCORES = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")
# Weights of the three scores, and the income from which an application is left out.
SCORE_WEIGHTS = (2.0, 1.0, 3.0)
INCOME_LIMIT = 20_000_000

#: Output column -> averaged column, then output column -> column whose spread is taken.
MEANS = {
    "GROUP_INCOME_MEAN": "AMT_INCOME_TOTAL",
    "GROUP_CREDIT_MEAN": "AMT_CREDIT",
    "GROUP_ANNUITY_MEAN": "AMT_ANNUITY",
    "GROUP_CREDIT_TO_ANNUITY_MEAN": "CREDIT_TO_ANNUITY_RATIO",
}
SPREADS = {
    "GROUP_INCOME_STD": "AMT_INCOME_TOTAL",
    "GROUP_EXT_SOURCES_STD": "EXT_SOURCES_MEAN",
    "GROUP_ANNUITY_STD": "AMT_ANNUITY",
    "GROUP_CREDIT_TO_ANNUITY_STD": "CREDIT_TO_ANNUITY_RATIO",
}
COLUMNS = [*PEER_KEYS, "GROUP_EXT_SOURCES_MEDIAN", *MEANS, *SPREADS]


def usable(applications: DataFrame) -> DataFrame:
    """Applications with a known gender and a plausible income; unemployed days filled."""
    return (
        applications.where("CODE_GENDER != 'XNA'")
        .where(F.col("AMT_INCOME_TOTAL") < INCOME_LIMIT)
        .na.fill(DAYS_SENTINEL, ["DAYS_EMPLOYED"])
    )


def row_features(applications: DataFrame) -> DataFrame:
    """Score statistics, age label and credit-to-annuity ratio of every application."""
    return applications.withColumns(
        {
            "EXT_SOURCES_MIN": row_min(SCORES),
            "EXT_SOURCES_MAX": row_max(SCORES),
            "EXT_SOURCES_MEAN": row_mean(SCORES),
            "EXT_SOURCES_PROD": row_product(SCORES),
            "EXT_SOURCES_WEIGHTED": row_weighted_sum(SCORES, SCORE_WEIGHTS),
            "EXT_SOURCES_NANMEDIAN": row_median(SCORES),
            "EXT_SOURCES_VAR": row_var_pop(SCORES),
            "AGE_RANGE": age_band("DAYS_BIRTH"),
            "CREDIT_TO_ANNUITY_RATIO": safe_ratio("AMT_CREDIT", "AMT_ANNUITY"),
        }
    )


def features(
    train: DataFrame, test: DataFrame, *, hot_rows: int = HOT_GROUP_ROWS
) -> DataFrame:
    """One row per peer group of both application tables; groups with an unknown key are left out."""
    applications = union_all(usable(train.drop("TARGET")), usable(test))
    rows = row_features(applications.where("SK_ID_CURR IS NOT NULL")).na.drop(
        subset=list(PEER_KEYS)
    )
    totals = {
        **{name: F.avg(c) for name, c in MEANS.items()},
        **{name: F.stddev_samp(c) for name, c in SPREADS.items()},
    }
    peers = group_median(
        rows,
        PEER_KEYS,
        "EXT_SOURCES_MEAN",
        "GROUP_EXT_SOURCES_MEDIAN",
        hot_rows=hot_rows,
        totals=totals,
    )
    return peers.na.fill(0.0, ["GROUP_EXT_SOURCES_MEDIAN"]).select(*COLUMNS)
