"""Registered queries: one per inventory row (variants get suffixed keys).

Each entry pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` with, where the operator is
SQL-expressible, the DuckDB oracle over the same parquet tables. Array outputs are rendered as
space-joined text in both so the value hashes compare.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from interlog.plans import oracle as O
from interlog.plans.train_features import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle_body: str | None = None):
    """Register a query; its oracle is cast to the Spark output types recorded in ``schemas.py``."""
    from interlog.plans.schemas import SCHEMAS

    def deco(fn):
        QUERIES[key] = fn
        if oracle_body is not None:
            q = O.sql(oracle_body)
            ORACLE[key] = O.typed(q, SCHEMAS[key]) if key in SCHEMAS else q
        return fn
    return deco


def arr_text(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.transform(c, lambda x: x.cast("string")), " ")


def T(spark, sf_dir):
    return tables(spark, sf_dir)


def load_all() -> None:
    """Import the query modules so that they register themselves (any import order works)."""
    from interlog.plans import q_aggs, q_core, q_io, q_more, q_stream  # noqa: F401
