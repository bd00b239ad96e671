"""Fields of the JSON ``properties`` text.

A JSON null, a missing key and malformed JSON all give NULL; one bad row never fails a job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unquoted(text: Column) -> Column:
    return F.replace(text, F.lit('"'), F.lit(""))


def json_text(col: Column, path: str) -> Column:
    """The value at ``path`` as text, without double quotes."""
    return unquoted(F.get_json_object(col, path))


def rounded_int(text: Column) -> Column:
    """Numeric text to the nearest integer, halves away from zero; NULL for other text."""
    return F.round(text.try_cast("double")).try_cast("int")


def json_int(col: Column, path: str) -> Column:
    return rounded_int(json_text(col, path))


def with_json_fields(df: DataFrame, col: str, fields: Sequence[str]) -> DataFrame:
    """Add several top-level fields as unquoted text, parsing each text once. Of a repeated
    key the last value counts."""
    raw = [f"_json_{f}" for f in fields]
    parsed = df.select("*", F.json_tuple(col, *fields).alias(*raw))
    return parsed.withColumns({f: unquoted(F.col(r)) for f, r in zip(fields, raw)}).drop(*raw)
