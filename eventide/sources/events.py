"""Event sources: the driver's ``events`` table, raw JSON messages, streams.

``events_from_table`` maps the test table onto the canonical event layout
(``id, event_type, date_event, lat, lng, location`` plus the arrival position
``seq``).  ``parse_events`` is the first hop of the pipeline: JSON text with
configurable field names -> typed events, all on JVM-side JSON functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DATE_EVENT, EVENT_TYPE, FLAT_COLUMNS, ID, LAT, LNG, LOCATION, SEQ, ColumnMapping

# Arrival orders derived from the test table.  ``ooo`` is a fixed shuffled
# arrival order (a permutation of event_id for fewer than 1000003 events).
OOO_MULTIPLIER = 7919
OOO_MODULUS = 1000003


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def epoch_millis(ts: Column) -> Column:
    """Epoch milliseconds (floor) of a TIMESTAMP_NTZ taken as UTC, independent of
    the session time zone."""
    from ..functions.timefmt import wall_clock_millis

    return wall_clock_millis(ts)


def events_from_table(
    spark: SparkSession, sf_dir: str, arrival: str = "event_id", ids: list[str] | None = None
) -> DataFrame:
    """Canonical events from the driver's ``events`` table.

    ``arrival="event_id"`` keeps the recorded arrival order (which is also time
    order); ``arrival="shuffled"`` uses the fixed permutation ``ooo``.  ``ids``
    keeps only those keys, filtered on the raw column so Parquet skips the rest
    (the transition rule is per key, so selecting keys first is exact)."""
    ev = read_table(spark, sf_dir, "events")
    if ids is not None:
        if all(i.lstrip("-").isdigit() for i in ids):
            ev = ev.where(F.col("user_id").isin([int(i) for i in ids]))
        else:
            ev = ev.where(F.col("user_id").cast("string").isin(list(ids)))
    k = F.get_json_object("props", "$.k").try_cast("int")
    if arrival == "event_id":
        seq = F.col("event_id")
    elif arrival == "shuffled":
        # ties (only beyond OOO_MODULUS events) broken by event_id: seq stays unique
        ooo = (F.col("event_id") * OOO_MULTIPLIER) % OOO_MODULUS
        seq = ooo * F.lit(1 << 32) + F.col("event_id")
    else:
        raise ValueError(f"unknown arrival order {arrival!r}")
    return ev.select(
        F.col("user_id").cast("string").alias(ID),
        F.col("event_type").alias(EVENT_TYPE),
        epoch_millis(F.col("ts")).alias(DATE_EVENT),
        F.col("value").alias(LAT),
        k.cast("double").alias(LNG),
        F.concat(F.lit("zone-"), (k % 10).cast("string")).alias(LOCATION),
        seq.alias(SEQ),
    )


def to_input_json(events: DataFrame, mapping: ColumnMapping = ColumnMapping(), value_col: str = "value") -> DataFrame:
    """Canonical events -> JSON messages with the mapping's field names (what the
    first hop reads from its topic).  ``seq`` is kept beside the message."""
    names = mapping.as_dict()
    fields = [F.col(c).alias(names[c]) for c in FLAT_COLUMNS]
    cols = [F.to_json(F.struct(*fields)).alias(value_col)]
    if SEQ in events.columns:
        cols.append(F.col(SEQ))
    return events.select(*cols)


def _number(text: Column, typ: str) -> Column:
    # "7" and 7 parse directly; "7.9" / 7.9 go through double (truncated for bigint).
    return F.coalesce(text.try_cast(typ), text.try_cast("double").try_cast(typ))


def _json_type(field: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(field), "^[A-Z]+", 0)


def typed_text(field: Column) -> Column:
    """A VARIANT field as text, by its JSON type: a string as it is, a number or a boolean as it is
    written, null as ``null``, an object or array as the empty text; a missing field is NULL."""
    kind = _json_type(field)
    return (
        F.when(field.isNull(), F.lit(None).cast("string"))
        .when(kind == "VOID", "null")
        .when(kind.isin("OBJECT", "ARRAY"), "")
        .otherwise(F.try_variant_get(field, "$", "string"))
    )


def typed_number(field: Column, typ: str) -> Column:
    """A VARIANT field as a number, by its JSON type: a number (cut off for ``bigint``), a text that
    is one, true as 1 and anything else as 0; a missing field is NULL."""
    text = F.try_variant_get(field, "$", "string")
    zero = F.lit(0).cast(typ)
    return (
        F.when(field.isNull(), F.lit(None).cast(typ))
        .when(_json_type(field) == "BOOLEAN", F.when(text == "true", F.lit(1).cast(typ)).otherwise(zero))
        .otherwise(F.coalesce(_number(F.trim(text), typ), zero))
    )


def parse_events(
    messages: DataFrame,
    mapping: ColumnMapping = ColumnMapping(),
    value_col: str = "value",
    coercion: str = "null",
    keep: list[str] | None = None,
) -> DataFrame:
    """JSON text -> canonical event columns (plus ``valid``).

    ``coercion="null"``: missing or unparsable fields become NULL and rows without
    id, event_type or date_event are marked ``valid = false``.
    ``coercion="zero"``: the reader's defaults, missing numbers -> 0, missing text
    -> ``""``; every row is valid.
    ``coercion="typed"``: by each field's JSON type (:func:`typed_text`, :func:`typed_number`);
    only missing fields are NULL, so rows without one of the three are not valid.
    """
    if coercion not in ("null", "zero", "typed"):
        raise ValueError("coercion must be 'null', 'zero' or 'typed'")
    names = mapping.as_dict()
    value = F.col(value_col).cast("string")
    extra = [F.col(c) for c in (keep or [])]
    if coercion == "typed":
        # One parse per message, into a VARIANT that keeps the JSON types.
        whole = messages.select(*extra, F.try_parse_json(value).alias("_json"))
        fields = whole.select(*extra, *[F.try_variant_get("_json", f"$['{names[c]}']", "variant").alias(f"_raw_{c}") for c in FLAT_COLUMNS])
        raw_of = {c: F.col(f"_raw_{c}") for c in FLAT_COLUMNS}
        typed = [typed_text(raw_of[c]).alias(c) for c in (ID, EVENT_TYPE)]
        typed += [typed_number(raw_of[c], t).alias(c) for c, t in ((DATE_EVENT, "bigint"), (LAT, "double"), (LNG, "double"))]
        return _with_valid(fields.select(*typed, typed_text(raw_of[LOCATION]).alias(LOCATION), *extra))
    # One JSON parse per message: json_tuple returns every field as text (numbers
    # as their literal, objects as JSON text, JSON null as NULL).
    raw_names = [f"_raw_{c}" for c in FLAT_COLUMNS]
    raw = messages.select(*extra, F.json_tuple(value, *[names[c] for c in FLAT_COLUMNS]).alias(*raw_names))
    field = dict(zip(FLAT_COLUMNS, (F.col(n) for n in raw_names)))
    id_c = field[ID]
    type_c = field[EVENT_TYPE]
    date_c = _number(field[DATE_EVENT], "bigint")
    lat_c = _number(field[LAT], "double")
    lng_c = _number(field[LNG], "double")
    loc_c = field[LOCATION]
    if coercion == "zero":
        id_c, type_c, loc_c = (F.coalesce(c, F.lit("")) for c in (id_c, type_c, loc_c))
        date_c = F.coalesce(date_c, F.lit(0).cast("bigint"))
        lat_c, lng_c = (F.coalesce(c, F.lit(0.0)) for c in (lat_c, lng_c))
    out = [
        id_c.alias(ID),
        type_c.alias(EVENT_TYPE),
        date_c.alias(DATE_EVENT),
        lat_c.alias(LAT),
        lng_c.alias(LNG),
        loc_c.alias(LOCATION),
    ]
    return _with_valid(raw.select(*out, *[F.col(c) for c in (keep or [])]))


def _with_valid(parsed: DataFrame) -> DataFrame:
    valid = F.col(ID).isNotNull() & F.col(EVENT_TYPE).isNotNull() & F.col(DATE_EVENT).isNotNull()
    return parsed.withColumn("valid", valid)


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, rejects) of a ``parse_events`` result."""
    return parsed.where("valid").drop("valid"), parsed.where("not valid").drop("valid")


# --- streaming sources ---------------------------------------------------------------


def kafka_messages(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Kafka topic as a stream of ``value`` text plus an arrival position
    ``seq`` (partition, offset).  ``max_offsets_per_trigger`` caps a micro-batch
    (and so what one key's group holds in a stateful task).  Needs the
    spark-sql-kafka package."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    raw = reader.load()
    # One id must stay in one topic partition for arrival order to be defined;
    # seq orders by offset within the partition.
    seq = F.col("partition").cast("long") * F.lit(1 << 40) + F.col("offset")
    return raw.select(F.col("value").cast("string").alias("value"), seq.alias(SEQ))


def json_file_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Directory of JSON-lines files (``value`` text and ``seq``) as a stream; the
    file twin of :func:`kafka_messages` used for tests."""
    reader = spark.readStream.schema("value string, seq long")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)
