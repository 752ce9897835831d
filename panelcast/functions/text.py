"""Label cleaning, names and JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.quarters import as_column


def clean_label(value: Column | str) -> Column:
    """Upper case with every run of other characters than letters and digits as one ``_``."""
    return F.upper(F.regexp_replace(as_column(value), "[^a-zA-Z0-9]+", "_"))


def sanitize_name(value: Column | str) -> Column:
    return F.translate(F.upper(as_column(value)), "/ -", "___")


def truncate_name(value: Column | str, max_len: int = 40) -> Column:
    c = as_column(value)
    return F.when(F.length(c) > max_len, F.concat(F.substring(c, 1, max_len), F.lit("..."))).otherwise(c)


def metric_key(value: Column | str, max_len: int = 50) -> Column:
    return F.substring(F.lower(F.translate(as_column(value), "/ -", "___")), 1, max_len)


def model_name(catalog: str, schema: str, prefix: str, partition: Column | str, model: Column | str) -> Column:
    """``catalog.schema.prefix_PARTITION_model``."""
    return F.format_string(
        "%s.%s.%s_%s_%s", F.lit(catalog), F.lit(schema), F.lit(prefix), sanitize_name(partition), F.lower(as_column(model))
    )


def parse_json_map(value: Column | str, value_type: T.DataType | None = None) -> Column:
    """JSON object text as a map; an empty map where the text is missing or empty."""
    schema = T.MapType(T.StringType(), value_type or T.DoubleType())
    empty = F.create_map().cast(schema)
    return F.coalesce(F.from_json(as_column(value), schema), empty)


def to_json_map(value: Column | str) -> Column:
    return F.to_json(as_column(value))
