"""The lenient integer cast equals Spark's own cast with ANSI mode off, on every short string."""

from itertools import product

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pavelake.functions.casting import lenient_int, lenient_timestamp
from pavelake.functions.numeric import round_half_even

EDGES = [
    "60", "60.5", "60.", ".5", ".", "-0.9", " 60 ", "1e2", "2147483647", "2147483648", "-2147483648", "-2147483649",
    "99999999999999999999", "FAST", "true", '{"a":1}', " 60", "60\n", "\n60", "\x0b7", "\x7f8\x00", "٣", "0x1A",
    "+", "-", "+.", "-.5", "1_000", "1,000", "00012", "-0", "+7.999", "7.9a", "7..1", "7 .1", "1\n2",
]


def mismatches(spark, strings):
    df = spark.createDataFrame([(s,) for s in strings], "s string").withColumn("ours", lenient_int(F.col("s")))
    rows = {(r.s, r.ours) for r in df.collect()}
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = df.select("s", F.col("s").cast("int").alias("legacy")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    return rows ^ {(r.s, r.legacy) for r in legacy}


def test_all_short_strings(spark):
    alphabet = "+-.07e \t"
    strings = ["".join(c) for n in range(5) for c in product(alphabet, repeat=n)]
    assert not mismatches(spark, strings + EDGES)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(max_codepoint=0x17F), max_size=8), min_size=200, max_size=200))
def test_random_strings(spark, strings):
    assert not mismatches(spark, set(strings))


def test_timestamps(spark):
    texts = ["2024-01-01T08:00:00.123456+00:00", "2024-01-01T08:00:00+02:00", "2024", "bad", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(lenient_timestamp(F.col("t")).cast("string")).collect()]
    assert got == ["2024-01-01 08:00:00.123456", "2024-01-01 06:00:00", "2024-01-01 00:00:00", None, None, None]


def test_time_of_day_is_today(spark):
    df = spark.createDataFrame([("08:00:00",)], "t string")
    assert df.select(F.to_date(lenient_timestamp(F.col("t"))) == F.current_date()).first()[0]


def test_rounding_equals_array_rounding(spark):
    import numpy as np

    values = [0.125, 0.375, 0.575, 0.285, -0.125, 2.5, 1e9 + 0.005, 0.0, 59.995]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(round_half_even(F.col("v"))).collect()] == list(np.round(values, 2))
