"""Canonical text: numbers over the whole range, times, intervals, strict parsing."""

from __future__ import annotations

import random
import struct
from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ColumnMismatch, TidemarkError, UnsupportedType
from tidemark.functions.canonical import (
    canonical_type,
    epoch_text,
    from_text,
    load_value,
    to_text,
    to_type,
    typed_literal,
)
from tidemark.functions.names import fold_name, quote_name, quote_path, resolve


def texts(spark, values, kind):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("x", kind)])
    df = spark.createDataFrame(list(enumerate(values)), schema)
    rows = df.select("i", to_text(F.col("x"), kind, "x").alias("t")).orderBy("i").collect()
    return [r["t"] for r in rows]


def read(spark, values, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    rows = df.select("i", from_text(F.col("x"), kind, "x").alias("t")).orderBy("i").collect()
    return [r["t"] for r in rows]


def test_double_text_of_known_values(spark):
    known = {
        7.0: "7",
        100.0: "100",
        0.0: "0",
        0.1: "0.1",
        -2.5: "-2.5",
        1e7: "10000000",
        12345678.5: "12345678.5",
        -12345678.25: "-12345678.25",
        1e10: "10000000000",
        1e-5: "0.00001",
        -1.25e-7: "-0.000000125",
        1e30: "1" + "0" * 30,
        5e-324: None,
        float(2**53): "9007199254740992",
        float(2**53 - 1): "9007199254740991",
        float("inf"): "inf",
        float("-inf"): "-inf",
    }
    found = texts(spark, list(known), T.DoubleType())
    for value, text in zip(known, found):
        expected = known[value]
        if expected is None:
            assert float(text) == value and "E" not in text and "e" not in text
        else:
            assert text == expected
    assert texts(spark, [float("nan"), None, -0.0], T.DoubleType()) == ["NaN", None, "-0"]


def test_double_text_reads_back_exactly_over_the_whole_range(spark):
    rng = random.Random(7)
    values = [struct.unpack("<d", rng.getrandbits(64).to_bytes(8, "little"))[0] for _ in range(4000)]
    values += [rng.uniform(-(2**54), 2**54) for _ in range(4000)]
    values += [round(rng.uniform(0, 1e12), 2) for _ in range(2000)]
    values = [v for v in values if v == v and abs(v) != float("inf")]
    for value, text in zip(values, texts(spark, values, T.DoubleType())):
        assert float(text) == value
        assert "e" not in text.lower()
        assert not ("." in text and text[-1] in "0.")


def test_float_text_reads_back_as_the_same_float(spark):
    assert texts(spark, [0.10000000149011612, 16777216.0, 2.5e9], T.FloatType()) == [
        "0.1",
        "16777216",
        "2500000000",
    ]
    rng = random.Random(11)
    values = [struct.unpack("<f", rng.getrandbits(32).to_bytes(4, "little"))[0] for _ in range(3000)]
    values = [v for v in values if v == v and abs(v) != float("inf")]
    for value, text in zip(values, texts(spark, values, T.FloatType())):
        assert struct.unpack("<f", struct.pack("<f", float(text)))[0] == value
        assert "e" not in text.lower()


def test_decimal_text(spark):
    values = [Decimal("0"), Decimal("1.50"), Decimal("-100"), Decimal("0.000000000000000001")]
    kind = T.DecimalType(38, 18)
    expected = ["0", "1.5", "-100", "0.000000000000000001"]
    assert texts(spark, values, kind) == expected
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert texts(spark, values, kind) == expected
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_a_comma_locale_changes_nothing(spark):
    locale = spark._jvm.java.util.Locale
    before = locale.getDefault()
    locale.setDefault(locale.GERMANY)
    try:
        df = spark.sql(
            "SELECT 1234567.25D AS d, 1.5BD AS n, 12345678.5D AS big, "
            "INTERVAL '1 02:03:04.5' DAY TO SECOND AS i"
        )
        shown = df.select([to_text(F.col(f.name), f.dataType).alias(f.name) for f in df.schema])
        assert tuple(shown.first()) == ("1234567.25", "1.5", "12345678.5", "+01 02:03:04.500000")
        back = shown.select([from_text(F.col(f.name), f.dataType).alias(f.name) for f in df.schema])
        assert back.first() == df.first()
    finally:
        locale.setDefault(before)


def test_integers_booleans_and_nulls(spark):
    assert texts(spark, [7, None], T.LongType()) == ["7", None]
    assert texts(spark, ["ab", None], T.StringType()) == ["ab", None]
    assert texts(spark, [True, False, None], T.BooleanType()) == ["1", "0", None]


def test_times_do_not_depend_on_the_session_zone(spark):
    # 02:30 does not exist on that day in the session's zone (see conftest).
    wall = datetime(2024, 3, 10, 2, 30, 0, 1200)
    assert texts(spark, [wall, None], T.TimestampNTZType()) == ["2024-03-10 02:30:00.001200", None]
    instant = spark.sql("SELECT timestamp '2024-03-10 02:30:00 UTC' AS t")
    shown = instant.select(to_text(F.col("t"), T.TimestampType())).first()[0]
    assert shown == "2024-03-10 02:30:00.000000 +00:00"
    assert texts(spark, [wall.date()], T.DateType()) == ["2024-03-10 00:00:00"]


def test_epoch_numbers(spark):
    df = spark.sql("SELECT 1717919999123456 AS us, -1L AS ms")
    row = df.select(epoch_text(F.col("us"), "us"), epoch_text(F.col("ms"), "ms")).first()
    assert tuple(row) == ("2024-06-09 07:59:59.123456", "1969-12-31 23:59:59.999000")
    with pytest.raises(UnsupportedType):
        epoch_text(F.col("us"), "ns")


def test_intervals_both_ways(spark):
    df = spark.sql(
        "SELECT INTERVAL '-3 04:05:06.5' DAY TO SECOND AS ds, INTERVAL '-2-3' YEAR TO MONTH AS ym, "
        "INTERVAL '100' HOUR AS h, INTERVAL '1200' MONTH AS m, "
        "cast(NULL AS INTERVAL DAY TO SECOND) AS none"
    )
    kinds = {f.name: f.dataType for f in df.schema}
    shown = df.select([to_text(F.col(c), k, c).alias(c) for c, k in kinds.items()])
    assert tuple(shown.first()) == ("-03 04:05:06.500000", "-02-03", "+04 04:00:00.000000", "+100-00", None)
    back = shown.select([from_text(F.col(c), k, c).alias(c) for c, k in kinds.items()])
    assert df.exceptAll(back).isEmpty() and back.exceptAll(df).isEmpty()


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.datetimes(datetime(1900, 1, 1), datetime(9999, 12, 31)), min_size=1, max_size=40
    )
)
def test_times_survive_the_round_trip(spark, values):
    shown = texts(spark, values, T.TimestampNTZType())
    assert shown == [v.strftime("%Y-%m-%d %H:%M:%S.%f") for v in values]
    assert read(spark, shown, T.TimestampNTZType()) == values


def test_boolean_words(spark):
    words = ["1", "true", "TRUE", "0", "false", "FALSE", None]
    assert read(spark, words, T.BooleanType()) == [True, True, True, False, False, False, None]


@pytest.mark.parametrize(
    ("kind", "bad"),
    [
        (T.BooleanType(), "yes"),
        (T.BooleanType(), "True"),
        (T.DoubleType(), "1,5"),
        (T.DoubleType(), "1.0d"),
        (T.DoubleType(), " 1"),
        (T.DoubleType(), "1\n"),
        (T.FloatType(), ""),
        (T.LongType(), "1.5"),
        (T.LongType(), "9223372036854775808"),
        (T.DecimalType(4, 2), "100"),
        (T.DateType(), "2024-01-01 10:00:00"),
        (T.TimestampNTZType(), "2024-02-30 00:00:00"),
        (T.TimestampNTZType(), "2024-02-03"),
        (T.TimestampNTZType(), "2024-02-03T00:00:00"),
        (T.TimestampType(), "2024-02-03 00:00:00 Europe/Berlin"),
        (T.DayTimeIntervalType(0, 3), "1 day"),
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_unreadable_text_fails_with_the_column_name(spark, kind, bad, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="column x: cannot read"):
            read(spark, [bad], kind)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_readable_forms(spark):
    assert read(spark, ["1e5", ".5", "5.", "-inf"], T.DoubleType()) == [1e5, 0.5, 5.0, float("-inf")]
    assert read(spark, ["2024-01-02 03:04:05"], T.TimestampNTZType()) == [datetime(2024, 1, 2, 3, 4, 5)]
    zoned = spark.createDataFrame(
        [("2024-01-02 03:04:05.5 +02:00",), ("2024-01-02 01:04:05.500000",)], "x string"
    ).select(F.unix_micros(from_text(F.col("x"), T.TimestampType(), "x")).alias("u"))
    first, second = [r["u"] for r in zoned.collect()]
    assert first == second
    assert read(spark, ["é"], T.BinaryType()) == [bytearray("é".encode())]


def test_conversion_by_target_type(spark):
    df = spark.sql(
        "SELECT 1 AS one, 112946.26D AS price, true AS yes, DATE '2024-01-02' AS day, "
        "timestamp '2024-01-02 03:04:05 UTC' AS at"
    )
    kinds = {f.name: f.dataType for f in df.schema}
    wanted = {
        "one": T.BooleanType(),
        "price": T.DecimalType(18, 2),
        "yes": T.LongType(),
        "day": T.TimestampNTZType(),
        "at": T.TimestampNTZType(),
    }
    row = df.select([to_type(F.col(c), kinds[c], w, c).alias(c) for c, w in wanted.items()]).first()
    assert tuple(row) == (
        True,
        Decimal("112946.26"),
        1,
        datetime(2024, 1, 2),
        datetime(2024, 1, 2, 3, 4, 5),
    )
    with pytest.raises(Exception, match="column price: cannot read '112946.26'"):
        df.select(to_type(F.col("price"), T.DoubleType(), T.LongType(), "price")).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    ("value", "fits"),
    [
        ("12.345", False), ("12.340", True), ("12345e-3", False), ("12340e-3", True),
        ("1.2e1", True), ("1500e-2", True), ("1e-99999999999", False), ("0e-9", True),
        ("-0.00", True), ("100", True), ("123456789", False), (".5", True), ("7.", True),
        (12.345, False), (12.25, True), (Decimal("1.2345"), False), (Decimal("1.2300"), True),
    ],
)
def test_decimals_are_not_rounded(spark, value, fits, ansi):
    have = {str: T.StringType(), float: T.DoubleType(), Decimal: T.DecimalType(18, 4)}[type(value)]
    want = T.DecimalType(10, 2)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(value,)], T.StructType().add("x", have))
        read = df.select(to_type(F.col("x"), have, want, "x"))
        if fits:
            assert read.first()[0] == Decimal(str(value))
        else:
            with pytest.raises(Exception, match="column x: cannot read"):
                read.collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_nested_types_have_no_canonical_form():
    with pytest.raises(UnsupportedType):
        canonical_type(T.ArrayType(T.FloatType()))
    with pytest.raises(UnsupportedType, match="embedding"):
        load_value(None, T.ArrayType(T.FloatType()), "embedding")


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("abc", T.LongType()),
        ("1.5", T.LongType()),
        ("1.239", T.DecimalType(10, 2)),
        ("3000000000", T.IntegerType()),
        ("2024-13-01 00:00:00.000000", T.TimestampNTZType()),
        ("yesterday", T.TimestampType()),
        ("x", T.BinaryType()),
    ],
)
def test_bad_watermarks_fail_at_once(spark, text, kind):
    with pytest.raises(TidemarkError):
        typed_literal(text, kind, "c")


def test_names():
    folded = {
        "events_sink": "EVENTS_SINK",
        "id": "ID",
        "MixedCase": "MIXEDCASE",
        "1table": "1table",
        "weird name": "weird name",
        'A"B': 'A"B',
    }
    for name, expected in folded.items():
        assert fold_name(name) == expected
    assert quote_name('A"B') == '"A""B"'
    assert quote_path("sales.events_sink") == '"SALES"."EVENTS_SINK"'
    assert resolve(["a", "A"], "A") == "A"
    assert resolve(["EVENT_ID"], "event_id") == "EVENT_ID"
    with pytest.raises(ColumnMismatch):
        resolve(["Id", "ID"], "id")
    with pytest.raises(ColumnMismatch):
        resolve(["a"], "b")
