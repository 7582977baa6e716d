"""Properties over generated readings. Each example holds many sensors, so that one Spark job tests many groups."""

import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import bandwright as bw

VALUES = st.one_of(
    st.none(),
    st.floats(-100, 100, allow_nan=False).map(lambda v: round(v, 2)),
    st.sampled_from([0.1, 0.0, 5.0, 1000.0, -1000.0, math.nan]),
)
ROWS = st.lists(st.tuples(st.sampled_from([None, *"abcdefghij"]), VALUES), max_size=80)
FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


def frame(spark, rows):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "id INT, sensor STRING, value DOUBLE")


def ids(df):
    return {row.id for row in df.select("id").collect()}


def brute_force(rows, k):
    groups = {}
    for i, (sensor, value) in enumerate(rows):
        if sensor is not None and value is not None and not math.isnan(value):
            groups.setdefault(sensor, []).append((i, value))
    kept, found, undecided, close = set(), set(), set(), set()
    for group in groups.values():
        values = [v for _, v in group]
        if len(values) == 1:
            undecided.add(group[0][0])
            continue
        mean = math.fsum(values) / len(values)
        sd = math.sqrt(math.fsum((v - mean) ** 2 for v in values) / (len(values) - 1))
        for i, v in group:
            (kept if len(set(values)) == 1 or abs(v - mean) <= k * sd else found).add(i)
            if abs(abs(v - mean) - k * sd) < 1e-9:
                close.add(i)
    return kept, found, undecided, close


@FEW
@given(rows=ROWS, k=st.sampled_from([0.5, 1.0, 1.7, 2.0, 3.0]))
def test_every_reading_has_one_fate(spark, rows, k):
    df = frame(spark, rows)
    kept = ids(bw.clean(df, "sensor", "value", k))
    found = ids(bw.detect_anomalies(df, "sensor", "value", k))
    rejected = ids(bw.rejected_rows(df))
    expected_kept, expected_found, undecided, close = brute_force(rows, k)
    assert kept ^ expected_kept <= close
    assert found ^ expected_found <= close
    assert not kept & found and not kept & rejected and not found & rejected
    assert kept | found | rejected | undecided == set(range(len(rows)))
    assert ids(bw.clean(df, "sensor", "value", k, on_undefined="keep")) == kept | undecided


@FEW
@given(rows=ROWS, budget=st.sampled_from([1, 500, 2000]))
def test_strategy_changes_nothing(spark, rows, budget):
    df = frame(spark, rows)
    assert ids(bw.clean(df, "sensor", "value", broadcast_bytes=budget)) == ids(bw.clean(df, "sensor", "value"))


@FEW
@given(rows=ROWS)
def test_complete_rows_are_those_of_dropna(spark, rows):
    df = frame(spark, rows)
    assert ids(df.where(bw.is_complete(df))) == ids(df.dropna())
    assert ids(df.where(bw.is_incomplete(df))) == ids(df) - ids(df.dropna())


@FEW
@given(rows=ROWS)
def test_larger_k_keeps_more(spark, rows):
    df = frame(spark, rows)
    baseline = bw.fit_baseline(df, "sensor", "value", bw.is_complete(df))
    kept = [ids(bw.clean(df, "sensor", "value", k, baseline=baseline)) for k in (0.5, 1, 2, 4)]
    assert all(a <= b for a, b in zip(kept, kept[1:]))


@FEW
@given(
    rows=st.lists(
        st.tuples(st.sampled_from("ab"), st.integers(-10**6, 10**6), st.floats(-100, 100).map(lambda v: round(v, 2))),
        max_size=60,
    ),
    hours=st.sampled_from([1, 6, 24, 168]),
)
def test_window_stats_by_hand(spark, rows, hours):
    df = spark.createDataFrame(rows, "k STRING, s BIGINT, v DOUBLE").withColumn("ts", F.timestamp_seconds("s"))
    stats = bw.window_stats(df, "k", "ts", "v", f"{hours} hours")
    have = {
        (r.k, r.s): (r.min_v, r.max_v, r.avg_v)
        for r in stats.withColumn("s", F.unix_timestamp("start")).collect()
    }
    want = {}
    for k, s, v in rows:
        want.setdefault((k, s // (hours * 3600) * hours * 3600), []).append(v)
    assert have.keys() == want.keys()
    for key, values in want.items():
        assert have[key] == (min(values), max(values), pytest.approx(math.fsum(values) / len(values), abs=1e-9))
