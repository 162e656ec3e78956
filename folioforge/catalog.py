"""All queries of the document-to-chunk engine and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .plans import oracles
from .plans.queries import Query, narrative_parts
from .plans.queries import queries as _queries


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into parts by the word limit."""
    return narrative_parts(spark, sf_dir)


def queries() -> dict[str, Query]:
    return _queries()


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLE)
