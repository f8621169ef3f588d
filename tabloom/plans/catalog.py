"""The registered queries: name, Spark plan and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None = None


class Catalog(dict[str, Query]):
    """Queries by name, filled through the decorator."""

    def query(self, sql: str | None = None) -> Callable[[Run], Run]:
        def register(run: Run) -> Run:
            self[run.__name__] = Query(run, sql)
            return run

        return register


def all_queries() -> dict[str, Query]:
    from tabloom.plans import (
        column_queries,
        corpus_queries,
        model_queries,
        patient_queries,
        sensor_queries,
        split_queries,
        tree_queries,
    )

    merged: dict[str, Query] = {}
    for module in (sensor_queries, column_queries, split_queries, patient_queries, corpus_queries, model_queries, tree_queries):
        merged.update(module.CATALOG)
    return merged
