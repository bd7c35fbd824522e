"""Property checks of the exact scalar rules against plain-Python definitions
(one Spark job per drawn batch)."""
import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st

from wardflow.functions import columns as C

TS = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2035, 12, 31))


def _floor_minute(t):
    return t.replace(second=0, microsecond=0)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(TS, TS), min_size=50, max_size=120))
def test_minute_rules_match_python(spark, pairs):
    df = spark.createDataFrame(pairs, "s timestamp_ntz, e timestamp_ntz")
    got = [(r.b, r.w, r.h) for r in df.select(C.minutes_boundary("e", "s").alias("b"),
                                               C.minutes_whole("e", "s").alias("w"),
                                               C.hours_whole("e", "s").alias("h")).collect()]
    exp = []
    for s, e in pairs:
        boundary = int((_floor_minute(e) - _floor_minute(s)).total_seconds() // 60)
        us = (e - s) // dt.timedelta(microseconds=1)
        whole = int(us / 60_000_000) if us >= 0 else -int(-us / 60_000_000)        # truncate toward zero
        hours = int(us / 3_600_000_000) if us >= 0 else -int(-us / 3_600_000_000)
        exp.append((boundary, whole, hours))
    assert got == exp


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60000), st.integers(0, 9999)), min_size=50, max_size=120))
def test_excel_serial_matches_python(spark, serials):
    texts = [f"{d}.{f:04d}" for d, f in serials]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.x for r in df.select(C.excel_or_datetime("t").alias("x")).collect()]
    epoch = dt.datetime(1899, 12, 30)
    exp = []
    for t in texts:
        v = float(t) * 86400
        secs = math.floor(v + 0.5)                     # round half up, as Spark's round on doubles
        exp.append(epoch + dt.timedelta(seconds=secs))
    assert got == exp


@settings(max_examples=3, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 150)), min_size=50, max_size=120))
def test_age_band_matches_python(spark, ages):
    df = spark.createDataFrame([(a,) for a in ages], "a long")
    got = [r.x for r in df.select(C.age_band("a").alias("x")).collect()]
    exp = []
    for a in ages:
        if a is None:
            exp.append(None)
            continue
        label = C.AGE_BAND_ELSE
        for lo, hi, name in C.AGE_BANDS:
            if lo <= a <= hi:
                label = name
                break
        exp.append(label)
    assert got == exp
