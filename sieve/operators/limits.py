"""The limit of a hit list, per query and without an upper bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import limit_rule


def query_limits(queries: DataFrame | None, k: int = 20, query_id: str = "query_id") -> tuple[int, DataFrame | None]:
    """``(kmax, limits)`` of a query table: the largest limit, and ``(query_id, _k)`` by query.

    A positive ``k`` of a query counts as is; null, zero and negative become
    the default ``k``, as do all without such a column (``limits`` is None)."""
    if queries is None or "k" not in queries.columns:
        return k, None
    limits = queries.select(F.col(query_id).alias("query_id"), limit_rule(F.col("k"), k).alias("_k"))
    return limits.agg(F.max("_k")).first()[0] or k, limits


def cut(ranked: DataFrame, limits: DataFrame | None) -> DataFrame:
    """Rows of ``ranked`` (cut to ``kmax`` before) whose rank is within their own query's limit."""
    if limits is None:
        return ranked
    return ranked.join(limits, "query_id").where(F.col("rank") <= F.col("_k")).drop("_k")
