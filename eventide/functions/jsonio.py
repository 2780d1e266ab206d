"""Row <-> JSON text, on Spark's JSON functions.

``encode`` is the sink side of the first hop (one compact JSON object per row,
NULL fields written out); ``decode`` is the second hop's source side (text ->
typed struct -> columns; malformed text gives an all-NULL row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import FLAT_CHANGE, FLAT_COLUMNS, HISTORY_ROW

_JSON_OPTS = {"ignoreNullFields": "false"}


def encode(df: DataFrame, columns: list[str] | None = None, value_col: str = "value") -> DataFrame:
    """One JSON object per row in a ``value`` column (a Kafka record value)."""
    cols = columns or df.columns
    return df.select(F.to_json(F.struct(*cols), _JSON_OPTS).alias(value_col))


def keyed(df: DataFrame, key_col: str = "id") -> DataFrame:
    """Record ``key`` (the row's ``key_col`` as text, if it has one) and JSON ``value``."""
    key = [F.col(key_col).cast("string").alias("key")] if key_col in df.columns else []
    return df.select(*key, F.to_json(F.struct(*df.columns), _JSON_OPTS).alias("value"))


def encode_events(changes: DataFrame) -> DataFrame:
    """Flat changes -> JSON text (the flat topic)."""
    return encode(changes, FLAT_COLUMNS)


def encode_history(rows: DataFrame) -> DataFrame:
    """History rows -> JSON text (the history topic)."""
    return encode(rows, [f.name for f in HISTORY_ROW.fields])


def decode(messages: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """JSON text (string or binary ``value``) -> the schema's columns."""
    text = F.col(value_col).cast("string")
    return messages.select(F.from_json(text, schema).alias("data")).select("data.*")


def decode_events(messages: DataFrame, value_col: str = "value") -> DataFrame:
    return decode(messages, FLAT_CHANGE, value_col)


def decode_history(messages: DataFrame, value_col: str = "value") -> DataFrame:
    return decode(messages, HISTORY_ROW, value_col)
