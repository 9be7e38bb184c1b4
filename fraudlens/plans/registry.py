"""Query registry: name -> (Spark callable(spark, sf_dir), DuckDB oracle SQL or None).

Every query reads the test tables (or data Spark derives from them) in
full.  Floating results are rounded on both sides; integer widths are cast
on both sides so schemas agree.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.plans import oracle as O
from fraudlens.sources.tables import read_table, transactions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def tx(spark, sf):
    return transactions(spark, sf)


def tbl(spark, sf, name):
    return read_table(spark, sf, name)


from fraudlens.plans import q_features, q_core, q_profile, q_model, q_neighbors  # noqa: E402,F401  (registers)
