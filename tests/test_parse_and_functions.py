"""First-hop parsing, JSON encode/decode, time and id arguments."""

import json

import pytest

from eventide.functions import jsonio, timefmt
from eventide.schema import FLAT_COLUMNS, ColumnMapping
from eventide.sources import events as src


def _parse(spark, payloads, **kw):
    df = spark.createDataFrame([(json.dumps(p) if not isinstance(p, str) else p, i) for i, p in enumerate(payloads)],
                               "value string, seq long")
    return src.parse_events(df, keep=["seq"], **kw).orderBy("seq").collect()


def test_numeric_text_and_fraction_coercion(spark):
    rows = _parse(spark, [
        {"ID": "a", "EVENT_TYPE": "X", "DATE_EVENT": "7", "LAT": "1.5", "LNG": 2, "LOCATION": "p"},
        {"ID": 5, "EVENT_TYPE": "X", "DATE_EVENT": 7.9, "LAT": 1, "LNG": "x", "LOCATION": None},
    ])
    assert (rows[0].date_event, rows[0].lat, rows[0].lng) == (7, 1.5, 2.0)
    assert rows[1].id == "5" and rows[1].date_event == 7 and rows[1].lng is None and rows[1].location is None
    assert rows[0].valid and rows[1].valid


def test_missing_fields_are_rejected_or_zeroed(spark):
    payloads = [{"ID": "a", "DATE_EVENT": 3}, "not json"]
    rows = _parse(spark, payloads)
    assert [r.valid for r in rows] == [False, False]
    zero = _parse(spark, payloads, coercion="zero")
    assert zero[0].event_type == "" and zero[0].lat == 0.0 and zero[0].valid
    assert zero[1].date_event == 0


def test_custom_mapping(spark):
    m = ColumnMapping("trainId", "kind", "when", "y", "x", "place")
    df = spark.createDataFrame([('{"trainId":"t1","kind":"K","when":10,"y":1.0,"x":2.0,"place":"s"}', 0)],
                               "value string, seq long")
    r = src.parse_events(df, mapping=m).first()
    assert (r.id, r.event_type, r.date_event, r.lat, r.lng, r.location) == ("t1", "K", 10, 1.0, 2.0, "s")


def test_mapping_rejects_empty_names():
    with pytest.raises(ValueError):
        ColumnMapping(id="")


def test_encode_decode_roundtrip(spark):
    from conftest import make_events

    ev = make_events(spark, [("a", "A", 1, 0), ("b", "B", 2, 1)]).select(*FLAT_COLUMNS)
    enc = jsonio.encode_events(ev)
    assert set(json.loads(enc.first().value)) == set(FLAT_COLUMNS)
    back = jsonio.decode_events(enc.select(enc.value.cast("binary").alias("value")))
    assert sorted(back.collect()) == sorted(ev.collect())


def test_decode_malformed_gives_null_row(spark):
    df = spark.createDataFrame([("{broken",)], "value string")
    r = jsonio.decode_history(df).first()
    assert r.id is None


def test_event_time(spark):
    assert timefmt.event_time_literal(spark, "20/01/2017", "12:31:00") == 1484915460000
    assert timefmt.event_time_literal(spark, "32/01/2017", "12:31:00") is None


def test_parse_ids(spark):
    assert timefmt.parse_ids("no-id") is None
    assert timefmt.parse_ids("a, b,c") == ["a", "b", "c"]
    from pyspark.sql import functions as F

    r = spark.range(1).select(timefmt.split_ids(F.lit("x,y")).alias("a"), timefmt.split_ids(F.lit("no-id")).alias("b")).first()
    assert r.a == ["x", "y"] and r.b is None


def test_times_do_not_depend_on_session_zone(spark):
    from pyspark.sql import functions as F

    from eventide.sources.events import epoch_millis

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = spark.createDataFrame([("2024-07-01 12:34:56.789999",)], "s string")
            ms = df.select(epoch_millis(F.col("s").cast("timestamp_ntz"))).first()[0]
            gap = timefmt.event_time_literal(spark, "10/03/2024", "02:30:00")
            assert (ms, gap) == (1719837296789, 1710037800000)
            assert timefmt.event_time_literal(spark, "1/01/2017", "12:31:00") is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
