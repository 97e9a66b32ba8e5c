import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.functions.flags import any_flag, fill_flags, reason_label
from tidewatch.functions.geo import haversine_km
from tidewatch.functions.messages import message_value, parse_transactions
from tidewatch.sources.cities import CITIES, gazetteer, lookup_city
from tidewatch.sources.messages import project_records

MESSAGE = (
    '{"transaction_id":"t1","user_id":"u1","amount":12.345,"timestamp":'
    '"2026-04-10T06:12:02.422031+00:00","city":"Paris","latitude":48.9,"longitude":2.35,'
    '"transaction_type":"purchase","merchant":"Fish, Chips & Co","is_seed_fraud":false}'
)


def distance(spark, points):
    df = spark.createDataFrame(points, "a double, b double, c double, d double")
    return [
        row[0] for row in df.select(haversine_km(*(F.col(c) for c in "abcd"))).collect()
    ]


def parsed(spark, *values):
    raw = spark.createDataFrame([(v,) for v in values], "value string")
    raw = raw.select(F.col("value").cast("binary").alias("value"), F.lit(None).cast("timestamp").alias("timestamp"))
    return parse_transactions(project_records(raw)).collect()


def test_known_distances(spark):
    place = {name: (lat, lon) for name, lat, lon in CITIES}
    expected = {
        ("New York", "Philadelphia"): 129.613,
        ("Houston", "San Antonio"): 304.339,
        ("London", "Paris"): 343.556,
        ("Dallas", "Houston"): 361.776,
        ("Dallas", "San Antonio"): 406.266,
        ("Los Angeles", "New York"): 3935.746,
    }
    found = distance(spark, [(*place[a], *place[b]) for a, b in expected])
    assert found == pytest.approx(list(expected.values()), abs=1e-3)


def test_missing_coordinates_are_no_distance(spark):
    nan = float("nan")
    assert distance(
        spark,
        [(None, None, 1.0, 2.0), (1.0, 2.0, None, 3.0), (1.0, 2.0, 3.0, None), (nan, 1.0, 2.0, 3.0)],
    ) == [0.0, 0.0, 0.0, 0.0]


def test_antipodes_are_finite(spark):
    points = [(lat, lon, -lat, lon + 180.0) for lat in (0.0, 12.3, 45.6, 89.9) for lon in (0.0, 77.7)]
    for km in distance(spark, points):
        assert km == pytest.approx(math.pi * 6371.0, abs=1e-3)


@settings(max_examples=20, deadline=None)
@given(
    st.lists(
        st.tuples(*[st.floats(-90, 90), st.floats(-180, 180)] * 2), min_size=1, max_size=50
    )
)
def test_distance_matches_the_spherical_cosine_law(spark, points):
    for (lat1, lon1, lat2, lon2), km in zip(points, distance(spark, points), strict=True):
        a, b, gap = math.radians(lat1), math.radians(lat2), math.radians(lon2 - lon1)
        cosine = math.sin(a) * math.sin(b) + math.cos(a) * math.cos(b) * math.cos(gap)
        assert km == pytest.approx(6371.0 * math.acos(max(-1, min(1, cosine))), abs=0.3)


def test_a_sound_message(spark):
    (row,) = parsed(spark, MESSAGE)
    assert (row.transaction_id, row.amount, row.merchant) == ("t1", 12.345, "Fish, Chips & Co")
    assert row.event_time.isoformat().endswith("06:12:02.422031")
    assert row.timestamp == "2026-04-10T06:12:02.422031+00:00"


def test_an_offset_is_applied(spark):
    rows = parsed(spark, *('{"timestamp":"2026-04-10T06:12:02%s"}' % z for z in ("+02:00", "Z")))
    assert [r.event_time.hour for r in rows] == [4, 6]


@pytest.mark.parametrize("value", [None, "", "{", "not json", '{"transaction_id'])
def test_malformed_messages_parse_to_nulls(spark, value):
    (row,) = parsed(spark, value)
    assert all(field is None for field in row)


def test_one_bad_field_leaves_the_others(spark):
    (row,) = parsed(spark, '{"transaction_id":5,"user_id":"u","amount":"oops","extra":1}')
    assert (row.transaction_id, row.user_id, row.amount) == ("5", "u", None)


def test_a_bad_time_is_null_not_an_error(spark):
    (row,) = parsed(spark, '{"transaction_id":"t","timestamp":"yesterday"}')
    assert row.event_time is None and row.timestamp == "yesterday"


def test_nan_amount_is_read_as_nan(spark):
    (row,) = parsed(spark, '{"amount":NaN}')
    assert math.isnan(row.amount)


def test_message_round_trip(spark):
    raw = spark.createDataFrame([(MESSAGE,)], "json_str string").withColumn(
        "kafka_ts", F.lit(None).cast("timestamp")
    )
    first = parse_transactions(raw)
    again = parse_transactions(first.select(message_value(first).alias("json_str"), "kafka_ts"))
    a, b = first.first().asDict(), again.first().asDict()
    assert b.pop("amount") == a.pop("amount")
    assert a == b


def test_messages_are_parsed_once(spark):
    from tidewatch.operators.validate import valid_rows

    raw = spark.createDataFrame([(MESSAGE,)], "json_str string").withColumn(
        "kafka_ts", F.lit(None).cast("timestamp")
    )
    plan = valid_rows(parse_transactions(raw))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_null_fields_are_written(spark):
    df = spark.createDataFrame(
        [("t", None, None, None, None, None, None, None, None, None)],
        "transaction_id string, user_id string, amount double, timestamp string, city string, "
        "latitude double, longitude double, transaction_type string, merchant string, "
        "is_seed_fraud boolean",
    )
    assert '"user_id":null' in df.select(message_value(df)).first()[0]


def test_labels(spark):
    flags = {"high_value": "a", "rapid_fire": "b", "location_anomaly": "c"}
    rows = [(x, y, z) for x in (True, False, None) for y in (True, False) for z in (True, False)]
    df = spark.createDataFrame(rows, "a boolean, b boolean, c boolean")
    for row in df.withColumn("label", reason_label(flags)).collect():
        names = [name for name, column in flags.items() if row[column]]
        assert row.label == ("+".join(names) or None)


def test_any_flag_is_never_null(spark):
    df = spark.createDataFrame([(None, False), (None, True), (None, None)], "a boolean, b boolean")
    assert [r[0] for r in df.select(any_flag(["a", "b"])).collect()] == [False, True, False]


def test_fill_flags_touches_only_the_named(spark):
    df = spark.createDataFrame([(None, None)], "a boolean, b boolean")
    assert tuple(fill_flags(df, ["a"]).first()) == (False, None)


def test_gazetteer(spark):
    rows = gazetteer(spark).orderBy("city_idx").collect()
    assert [tuple(r)[1:] for r in rows] == list(CITIES)
    found = lookup_city(spark.createDataFrame([("Tokyo",), ("Atlantis",)], "city string")).collect()
    assert [(r.city, r.city_latitude) for r in found] == [("Tokyo", 35.6762)]
