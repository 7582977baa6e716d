"""What the optimizer makes of each operator: pushed filters, pruned columns, number of shuffles."""

import re

import bandwright as bw


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(df, name):
    return len(re.findall(re.escape(name), plan(df)))


def events(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet")


def test_clean_filters_at_the_scan_and_moves_no_reading(spark, sf):
    df = events(spark, sf).select("user_id", "ts", "value")
    text = plan(bw.clean(df, "user_id", "value"))
    assert "PushedFilters: [IsNotNull(user_id), IsNotNull(ts), IsNotNull(value)]" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text
    assert "hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_statistics_after_cleaning_shuffle_once(spark, sf):
    df = events(spark, sf).select("user_id", "ts", "value")
    stats = bw.window_stats(bw.clean(df, "user_id", "value"), "user_id", "ts", "value")
    assert nodes(stats, "Exchange hashpartitioning") == 1
    assert nodes(stats, "partial_stddev_samp") == 1
    assert "SortMergeJoin" not in plan(stats)


def test_statistics_read_only_their_columns(spark, sf):
    stats = bw.window_stats(events(spark, sf), "user_id", "ts", "value")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan(stats)


def test_anomalies_move_no_reading(spark, sf):
    text = plan(bw.detect_anomalies(events(spark, sf), "user_id", "value", keep=["ts", "user_id", "value"]))
    assert "hashpartitioning" not in text and "SortMergeJoin" not in text
    assert "IsNotNull(value)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text


def test_rejected_rows_are_a_filter(spark, sf):
    df = events(spark, sf).select("event_id", "event_type")
    text = plan(bw.rejected_rows(df))
    assert "Exchange" not in text
    assert "PushedFilters: [Or(IsNull(event_id),IsNull(event_type))]" in text


def test_completeness_spreads_each_group(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet")
    result = bw.group_completeness(df, "l_orderkey", "l_linenumber", 5)
    text = plan(result)
    assert re.search(r"hashpartitioning\(l_orderkey#\d+L, l_linenumber#\d+", text)
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text


def test_no_python_in_any_plan(spark, sf):
    import catalogue

    for name in ("clean_events", "anomalies_events", "rejected_events", "window_stats_events", "completeness_orders"):
        assert "Python" not in plan(catalogue.QUERIES[name](spark, sf))
