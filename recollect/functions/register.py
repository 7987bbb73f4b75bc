"""Functions by name for SQL: ``register(spark)`` makes them known to a session."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import SparkSession

from recollect.functions import embed, temporal

#: Name and parameters, type, and the expression that a call stands for.
SQL_FUNCTIONS = (
    ("recollect_root(label STRING)", "STRING", "split_part(label, '/', 1)"),
    ("recollect_tokens(text STRING)", "ARRAY<STRING>", r"regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+', 0)"),
    ("recollect_contains(text STRING, operand STRING)", "BOOLEAN", "text IS NOT NULL AND size(recollect_tokens(operand)) > 0 AND size(array_except(recollect_tokens(operand), recollect_tokens(text))) = 0"),
    ("recollect_decay(age_days DOUBLE, half_life DOUBLE)", "DOUBLE", "pow(0.5D, greatest(age_days, 0D) / half_life)"),
    ("recollect_trust(helpful BIGINT, unhelpful BIGINT)", "DOUBLE", "bround((helpful + 1D) / (helpful + unhelpful + 2D), 4)"),
    ("recollect_valid_id(id STRING)", "BOOLEAN", r"coalesce(id RLIKE '\\A(?:[0-9]{1,20}|[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12})\\z', false)"),
    ("recollect_jaccard(a ARRAY<STRING>, b ARRAY<STRING>)", "DOUBLE", "coalesce(size(array_intersect(a, b)) / nullif(size(array_union(a, b)), 0), 0D)"),
)


def register(spark: SparkSession, now: datetime | None = None, dims: int = 64) -> list[str]:
    """Make the functions known; returns their names. ``recollect_window`` names times as of ``now``."""
    names = []
    for call, kind, body in SQL_FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {call} RETURNS {kind} RETURN {body}")
        names.append(call.partition("(")[0])
    spark.udf.register("recollect_window", temporal.window_udf(now or datetime.now(UTC)))
    spark.udf.register("recollect_embed", embed.hash_embedder(dims))
    return [*names, "recollect_window", "recollect_embed"]
