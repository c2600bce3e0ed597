"""NULL keys, times and values, unseen pivot values, odd timestamps and out-of-range text."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import aggregate as agg
from tidewater.operators import windows
from tidewater.operators.joins import salted_join
from tidewater.streaming.events import parse_events

DAY = dt.datetime(2024, 1, 1)


def _rows(spark):
    at = lambda d: None if d is None else DAY + dt.timedelta(days=d)
    data = [
        (1, "a", at(0), 10), (2, "a", at(45), None), (3, "a", at(90), 5), (4, None, at(0), 7), (5, None, at(200), 1),
        (6, "a", None, 2), (7, "b", at(3), None), (8, "b", at(4), None), (9, None, None, 3),
    ]
    return spark.createDataFrame(data, "id long, user string, ts timestamp_ntz, v long")


def _same(got, want, *cols):
    key = lambda df: sorted(map(str, df.select("id", *cols).collect()))
    assert key(got) == key(want)


def test_running_total_with_nulls(spark):
    df = _rows(spark)
    w = Window.partitionBy("user").orderBy("ts").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    _same(windows.running_total(df, "user", "ts", F.col("v"), "total"), df.withColumn("total", F.sum("v").over(w)), "total")


def test_lag_lead_with_nulls(spark):
    df = _rows(spark)
    w = Window.partitionBy("user").orderBy("ts", "id")
    want = df.withColumns({"prev_value": F.lag("v").over(w), "next_value": F.lead("v").over(w)})
    _same(windows.lag_lead(df, "user", "ts", "id", "v"), want, "prev_value", "next_value")


def test_rolling_mean_with_nulls(spark):
    df = _rows(spark).where("ts is not null").unionByName(
        spark.createDataFrame([(20, "c", DAY, 10), (21, "c", DAY + dt.timedelta(days=19), 4), (22, "c", DAY + dt.timedelta(days=20), None)], "id long, user string, ts timestamp_ntz, v long")
    )
    df.createOrReplaceTempView("nulls_rolling")
    want = spark.sql("select id, sum(v) over w rolling_sum, count(v) over w rolling_n from nulls_rolling window w as (partition by user order by ts range between interval 7 days preceding and current row)")
    _same(windows.rolling_mean(df, "user", "ts", F.col("v"), "id"), want, "rolling_sum", "rolling_n")


def test_sessions_keep_rows_without_user_or_time(spark):
    got = {r.id: r.session_id for r in windows.sessionize(_rows(spark), "user", "ts", "id").collect()}
    assert len(got) == 9
    assert got[6] == 1 and got[1] == 2 and got[9] == 1 and got[4] == 2


def test_pivot_keeps_unseen_values(spark):
    df = spark.createDataFrame([("d", "click", 1), ("d", "refund", 7)], "day string, kind string, v long")
    assert agg.pivot_sum(df, "day", "kind", None, F.sum("v")).collect()[0].refund == 7


@pytest.mark.parametrize("how", ["right", "full", "right_outer", "full_outer"])
def test_salted_join_rejects_sides_it_would_repeat(spark, how):
    df = spark.createDataFrame([(1, "x")], "k long, v string")
    with pytest.raises(ValueError):
        salted_join(df, df.withColumnRenamed("v", "w"), "k", 4, how=how)


def test_event_times(spark):
    good = ["2024-01-01T00:00:07.179575Z", "2024-01-01T00:00:07.179575+00:00", "2024-01-01T00:00:07+00:00", "2024-01-01T02:00:07+02:00"]
    bad = ["yesterday", "2024-01-01T00:00:07", "2024-13-01T00:00:07Z", ""]
    rows = [(f'{{"event_type":"order","timestamp":"{t}"}}',) for t in good + bad] + [("not json",), (None,)]
    got = parse_events(spark.createDataFrame(rows, "value string")).collect()
    assert [r.is_valid for r in got] == [True] * 4 + [False] * 6
    assert len({r.ts.replace(microsecond=0) for r in got[:4]}) == 1
