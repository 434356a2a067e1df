"""Named queries over the driver's tables, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import imagery, labelling, learning, search, spatial

_PARTS = (search, labelling, spatial, imagery, learning)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for part in _PARTS for name, (run, _) in part.PLANS.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, (_, sql) in part.PLANS.queries.items() if sql}
