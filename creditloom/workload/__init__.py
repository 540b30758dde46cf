"""Queries over the shared test tables, each with the SQL that gives the same rows."""

from creditloom.workload import aggregates, columns, features, joins, periods, storage, streams
from creditloom.workload.registry import callables, statements

__all__ = [
    "aggregates",
    "callables",
    "columns",
    "features",
    "joins",
    "periods",
    "statements",
    "storage",
    "streams",
]
