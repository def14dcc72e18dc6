import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logscan.functions.text import compose_text, float_text, mask_message, parse_time
from pyrules import mask, parse, same, text_of

MASK_CASES = [
    ("User12 from 192.168.1.102 and 1.2.3.4.5 user7 User8x", "[USER] from [IP] and [IP].5 user7 User8x"),
    (None, "None"),
    ("Performance Warnings", "Performance Warnings"),
    ("999.999.999.999 is not checked", "[IP] is not checked"),
    ("x1.2.3.4 y", "x1.2.3.4 y"),
    ("User1,User22;(User3)", "[USER],[USER];([USER])"),
]

TIME_CASES = [
    ("28ms", 28.0), (None, 0.0), ("bad", 0.0), ("28MS", 0.0), ("28fms", 0.0), ("28d", 0.0),
    ("0x1p3ms", 0.0), ("ms", 0.0), ("1__0ms", 0.0), (" 28ms ", 0.0), ("28ms\n", 0.0),
    ("28", 28.0), (" 28 ms", 28.0), ("28\tms", 28.0), ("1_000ms", 1000.0), ("1e3ms", 1000.0),
    (".5ms", 0.5), ("+3ms", 3.0), ("1e40ms", math.inf), ("-infms", -math.inf),
    ("28msms", 0.0), ("12.3ms", float(np.float32(12.3))), ("Infinity", math.inf), ("-1_0.2_5ms", -10.25),
    ("\x1c28ms", 0.0), ("\u300028\u3000ms", 28.0), ("28\x85", 28.0), ("\xa0inf ms", math.inf),
]


def test_mask_cases(spark):
    df = spark.createDataFrame([(a,) for a, _ in MASK_CASES], "m string")
    got = [r[0] for r in df.select(mask_message("m")).collect()]
    assert got == [b for _, b in MASK_CASES]
    assert got == [mask(a) for a, _ in MASK_CASES]


def test_parse_cases(spark):
    df = spark.createDataFrame([(a,) for a, _ in TIME_CASES], "t string")
    got = [r[0] for r in df.select(parse_time("t").cast("double")).collect()]
    for (inp, want), g in zip(TIME_CASES, got):
        assert same(g, want), (inp, g, want)
        assert same(g, parse(inp)), (inp, g)


def test_nan_time(spark):
    df = spark.createDataFrame([("nanms",), ("NaN",)], "t string")
    assert all(math.isnan(r[0]) for r in df.select(parse_time("t")).collect())


def test_float_text_widening(spark):
    vals = [12.3, 28.0, 1e7, 12345678.9, 1e-5, 0.00012, 1e16, 1.5e20, 3.4e38, 0.001, 0.0, -2.5,
            99.999, 1e-4, 123456.7, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(float_text(F.col("v").cast("float"))).collect()]
    assert got == [text_of(v) for v in vals]


def test_compose_text(spark):
    df = spark.createDataFrame([("ERROR", "ServiceA", "Disk full", 12.3)], "l string, s string, m string, t double")
    r = df.select(compose_text("l", "s", "m", F.col("t").cast("float")).alias("a"),
                  compose_text("l", "s", "m").alias("b")).first()
    assert r.a == "LOGLEVEL=ERROR SERVICE=ServiceA TIME=12.300000190734863 TEXT=Disk full"
    assert r.b == "LOGLEVEL=ERROR SERVICE=ServiceA TEXT=Disk full"


_time_text = st.one_of(
    st.text(alphabet="0123456789.eE+-_ msMSinfatyx\t\n\x0b\x1c\x1f\x85\xa0\u2003\u3000", max_size=12),
    st.floats(allow_nan=False, width=32).map(lambda v: f"{v}ms"),
    st.integers(-10**6, 10**6).map(lambda v: f"{v}ms"),
)
_msg = st.text(alphabet="0123456789.User ser,;x", max_size=40)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(_time_text, _msg), min_size=1, max_size=40))
def test_property_against_python_rules(spark, rows):
    df = spark.createDataFrame(rows, "t string, m string")
    got = df.select(parse_time("t").cast("double").alias("v"), mask_message("m").alias("m")).collect()
    for (t, m), r in zip(rows, got):
        assert same(r.v, parse(t)), (t, r.v, parse(t))
        assert r.m == mask(m), (m, r.m)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=True, width=32), min_size=1, max_size=50))
def test_property_float_text(spark, vals):
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = [r[0] for r in df.select(float_text(F.col("v").cast("float"))).collect()]
    assert got == [text_of(v) for v in vals]
