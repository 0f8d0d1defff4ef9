"""Envelope encode/decode, permissive parsing, partition reports."""

from pyspark.sql import functions as F

from sensorlake.functions.parse import parse_readings
from sensorlake.operators.partitions import counts, reader_load, skew
from sensorlake.sources.log import SourceSpec, decode_envelope, read_partitions, source_options, to_envelope


def test_permissive_json(spark):
    df = spark.createDataFrame([("{bad",), ('{"sensor_id": 7, "temperature": "12.5"}',),
                                ('{"temperature": NaN, "extra": 1}',), (None,)], "value string")
    r = parse_readings(df, keep=("value",)).collect()
    assert len(r) == 4                                  # a NULL message is kept as a row of NULLs
    assert all(v is None for v in r[0][1:]) and all(v is None for v in r[3])
    assert r[1].sensor_id == "7" and r[1].temperature is None
    assert r[2].temperature != r[2].temperature   # NaN


def test_envelope_round_trip_and_null_key(spark):
    df = spark.createDataFrame([(1, "sensor_1", "2024-01-01 00:00:00", None, 1.0, "idle"),
                                (2, "", "x", 2.0, None, None)],
                               "event_id long, sensor_id string, timestamp string, temperature double, "
                               "humidity double, status string")
    env = to_envelope(df)
    rows = env.collect()
    assert rows[0].key == bytearray(b"sensor_1") and rows[1].key is None
    assert b'"temperature":null' in bytes(rows[0].value)
    back = decode_envelope(env).orderBy("offset").collect()
    assert back[0].temperature is None and back[1].temperature == 2.0 and back[0].event_time is not None


def test_counts_zero_fill_and_readers(spark):
    df = spark.createDataFrame([(0,), (0,), (2,)], "partition int")
    c = counts(df, 3)
    assert sorted((r.partition, r.n) for r in c.collect()) == [(0, 2), (1, 0), (2, 1)]
    load = {(r.readers, r.reader): (r.partitions, r.n) for r in reader_load(c, 3, (1, 2, 4)).collect()}
    assert load[(1, 0)] == ("0,1,2", 3)
    assert load[(2, 0)] == ("0,2", 3) and load[(2, 1)] == ("1", 0)
    assert load[(4, 3)] == ("", 0)
    s = skew(c).first()
    assert s.empty_partitions == 1 and abs(s.max_share - 2 / 3) < 1e-12


def test_read_partitions_and_options(spark):
    df = spark.createDataFrame([(0,), (1,), (2,)], "partition int")
    assert read_partitions(df, []).count() == 0
    assert read_partitions(df, [0, 2]).count() == 2
    opts = source_options(SourceSpec(topic="t", bootstrap_servers="b:9092", partitions=(0, 2)), bounded=True)
    assert opts["assign"] == '{"t":[0,2]}' and opts["startingOffsets"] == "earliest"
    assert source_options(SourceSpec(topic="t"))["startingOffsets"] == "latest"
