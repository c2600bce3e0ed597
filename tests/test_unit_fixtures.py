"""Small literal tables (S11): ties at the top, exact gaps, repeated keys, NULL amounts and NULL keys, with the rows worked out by hand."""

import datetime as dt

from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.functions.udfs import name_code, name_code_udf, register_normalize_phone
from tidewater.operators import aggregate as agg
from tidewater.operators import sets, windows
from tidewater.plans import models


def _key(t):
    return tuple((v is not None, v) for v in t)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


def test_mean_fill_keeps_double_and_counts_repeats_once(spark):
    df = spark.createDataFrame([(7, "Ola", 4), (8, None, 9), (8, None, 9), (9, "Ulf", None)], "id long, name string, weight long")
    d = agg.keep_one_per_key(df, "id", ["name", "weight"])
    filled = agg.fill_with_mean(d, "weight").fillna("nameless", subset=["name"])
    assert rows(filled, "id", "name", "weight") == [(7, "Ola", 4.0), (8, "nameless", 9.0), (9, "Ulf", 6.5)]


def test_sum_avg_and_top_one(spark):
    df = spark.createDataFrame([("n", 30), ("s", 8), ("n", 15), ("s", None), ("w", 45)], "shop string, paid long")
    s = df.groupBy("shop").agg(F.sum("paid").alias("total"), F.avg("paid").alias("avg"))
    assert rows(s, "shop", "total", "avg") == [("n", 45, 22.5), ("s", 8, 8.0), ("w", 45, 45.0)]
    assert agg.top_k(s, [F.col("total").desc(), F.col("shop")], 1).first()["shop"] == "n"


def test_top_per_group_with_ties_and_null_group(spark):
    data = [("red", k, v) for k, v in zip("abcdef", (5, 9, 9, 2, 9, 7))]
    data += [("blue", k, v) for k, v in zip("gh", (1, 1))] + [(None, "i", 4), (None, "j", 3)]
    df = spark.createDataFrame(data, "team string, player string, points long")
    best = windows.top_n_per_group(df, "team", [F.col("points").desc(), F.col("player")], 1, salt_buckets=3)
    assert rows(best, "team", "player", "points") == [(None, "i", 4), ("blue", "g", 1), ("red", "b", 9)]
    ties = windows.top_n_per_group(df, "team", [F.col("points").desc()], 1, method="rank", salt_buckets=3)
    assert rows(ties, "player") == [("b",), ("c",), ("e",), ("g",), ("h",), ("i",)]
    dense = windows.top_n_per_group(df, "team", [F.col("points").desc()], 2, method="dense_rank", salt_buckets=4)
    assert rows(dense.filter("team = 'red'"), "player") == [("b",), ("c",), ("e",), ("f",)]


def test_anti_join_and_totals(spark):
    shelf = spark.createDataFrame([(n, f"shelf {n}") for n in range(4)], "id long, label string")
    boxes = spark.createDataFrame([(0, 6), (2, 1), (0, 4), (3, 0), (None, 5)], "shelf_id long, size long")
    assert rows(shelf.join(boxes, shelf.id == boxes.shelf_id, "left_anti"), "label") == [("shelf 1",)]
    total = boxes.groupBy("shelf_id").agg(F.sum("size").alias("size"))
    assert rows(total, "shelf_id", "size") == [(None, 5), (0, 10), (2, 1), (3, 0)]


def test_orphans_inner_and_anti(spark):
    keys = spark.createDataFrame([(11,), (12,)], "id long")
    facts = spark.createDataFrame([(12, "x"), (13, "y"), (12, "z"), (None, "w")], "ref long, tag string")
    assert rows(keys.join(facts, keys.id == facts.ref), "id", "tag") == [(12, "x"), (12, "z")]
    assert rows(facts.join(keys, keys.id == facts.ref, "left_anti"), "tag") == [("w",), ("y",)]


def test_duplicates_with_null_key(spark):
    df = spark.createDataFrame([(x,) for x in ("p", None, "q", "p", "p", None)], "code string")
    got = {r["code"]: r["count"] for r in agg.duplicates(df, "code").collect()}
    assert got["p"] == 3 and "q" not in got
    assert df.distinct().count() == 3


def test_running_total_and_lag_across_chunks(spark):
    at = lambda day: dt.datetime(2031, 5, day, 6)
    df = spark.createDataFrame([("k", at(2), 7), ("k", at(3), -2), ("k", at(9), 40), ("m", at(4), 1)], "owner string, at timestamp_ntz, amount long")
    rt = windows.running_total(df, "owner", "at", F.col("amount"), chunk_seconds=2 * 86400)
    assert rows(rt, "owner", "running_total") == [("k", 5), ("k", 7), ("k", 45), ("m", 1)]
    ll = windows.lag_lead(df.withColumn("k", F.col("amount")), "owner", "at", "k", "amount", chunk_seconds=86400)
    got = [(r["prev_value"], r["next_value"], r["diff_from_prev"]) for r in ll.filter("owner = 'k'").orderBy("at").collect()]
    assert got == [(None, -2, None), (7, 40, -9), (-2, None, 42)]


def test_sessions_by_gap(spark):
    # minutes after the start; a gap of exactly 30 stays in the session, anything longer opens a new one
    plan = {"calm": ([0, 30, 60, 90], 1), "over": ([0, 30, 60.02], 2), "far": ([0, 500, 501], 2), "lone": ([3], 1), "night": ([880, 905, 990], 2)}
    start = dt.datetime(2031, 5, 2, 9)
    data = [(who, start + dt.timedelta(minutes=m)) for who, (minutes, _) in plan.items() for m in minutes]
    df = spark.createDataFrame(data, "user string, ts timestamp").withColumn("eid", F.monotonically_increasing_id())
    s = windows.sessionize(df, "user", "ts", "eid", 30, chunk_seconds=3600)
    n = s.groupBy("user").agg(F.max("session_id").alias("n"))
    assert rows(n, "user", "n") == sorted((who, k) for who, (_, k) in plan.items())


def test_pivot_in_calendar_order(spark):
    data = [("Dec", "u", 3), ("Feb", "v", 8), ("Dec", "u", 4), ("Sep", "u", 1), ("Feb", "u", 2)]
    df = spark.createDataFrame(data, "month string, kind string, amount long")
    p = agg.pivot_sum(df, "month", "kind", ["u", "v"], F.sum("amount"))
    p = p.withColumn("m", agg.calendar_order("month")).orderBy("m").drop("m")
    assert [tuple(r) for r in p.collect()] == [("Feb", 2, 8), ("Sep", 1, None), ("Dec", 7, None)]


def test_explode_drops_empty_arrays(spark):
    df = spark.createDataFrame([(1, ["k", "k"]), (2, []), (3, None), (4, [None, "l"])], "id long, tags array<string>")
    assert rows(df.select("id", F.explode("tags").alias("tag")), "id", "tag") == [(1, "k"), (1, "k"), (4, None), (4, "l")]


def test_nested_json_with_malformed_row(spark):
    df = spark.createDataFrame([('{"a": {"n": 5, "w": "up"}}',), ("[1,",), ('{"a": {"n": 6}}',)], "j string")
    flat = df.select(F.from_json("j", "a STRUCT<n: INT, w: STRING>").alias("d")).select("d.a.n", "d.a.w")
    assert rows(flat, "n", "w") == [(None, None), (5, "up"), (6, None)]


def test_sales_etl_reports(spark):
    # a repeated order, a NULL amount (filled), a NULL customer (dropped), a customer without orders
    orders = spark.createDataFrame(
        [(21, 1, "d1", 80.0), (22, 1, "d2", 20.0), (23, 2, "d1", None), (24, None, "d3", 999.0), (25, 3, "d3", 60.0), (25, 3, "d3", 60.0), (26, 4, "d4", 10.0)],
        "order_id long, customer_id long, date string, amount double")
    customers = spark.createDataFrame(
        [(1, "Oslo", "a"), (2, "Oslo", "b"), (3, "Bern", "b"), (3, "Bern", "b"), (4, "Bern", "a"), (5, "Riga", "a")],
        "customer_id long, city string, segment string")
    rep = models.sales_etl(orders, customers, fill_amount=25.0)
    assert rows(rep["by_city"], "city", "total_sales", "orders") == [("Bern", 70.0, 2), ("Oslo", 125.0, 3)]
    assert rows(rep["top_customers"], "customer_id", "total_spent") == [(1, 100.0), (2, 25.0), (3, 60.0)]
    assert rows(rep["avg_by_segment"], "segment", "avg_order_value") == [("a", 110 / 3), ("b", 42.5)]


def test_name_codes_native_and_udf(spark):
    df = spark.createDataFrame([("Ivo", "Lund", 63), ("Tea", "Roos", 5), ("Bo", "Ek", 104)], "f string, l string, age int")
    native = df.select("f", name_code("f", "l", "age").alias("u"))
    udf = df.select("f", name_code_udf("f", "l", "age").alias("u"))
    expected = [("Bo", "BEk0"), ("Ivo", "ILund6"), ("Tea", "TRoos")]
    assert rows(native, "f", "u") == expected
    assert rows(udf, "f", "u") == expected


def test_global_reduce_and_ends(spark):
    df = spark.createDataFrame([(v,) for v in (-4, 17, 6, -4, 0)], "value long")
    r = agg.global_reduce(df, "value").first()
    assert (r.sum_value, r.max_value, r.min_value, r.fold_value) == (15, 17, -4, 15)
    assert [x.value for x in agg.top_k(df, [F.col("value").desc()], 2).collect()] == [17, 6]
    assert [x.value for x in agg.top_k(df, [F.col("value")], 3).collect()] == [-4, -4, 0]
    assert agg.rows_at_minimum(df, "value").count() == 2


def test_counts_by_value(spark):
    c = spark.createDataFrame([(v,) for v in "zyxzyz"], "value string")
    assert rows(agg.count_by(c, "value"), "value", "count") == [("x", 1), ("y", 2), ("z", 3)]
    top = agg.count_by(c, "value").orderBy(F.col("count").desc(), "value").first()
    assert (top["value"], top["count"]) == ("z", 3)


def test_set_operations_duplicate_rules(spark):
    table = lambda *vs: spark.createDataFrame([(v,) for v in vs], "v long")
    a, b = table(30, 30, 31, 32, 32, None), table(32, None, 31)
    assert rows(sets.subtract_all_copies(a, b), "v") == [(30,), (30,)]
    assert rows(sets.intersection(a, b), "v") == [(None,), (31,), (32,)]
    assert sets.union_all(a, b).count() == 9
    assert rows(sets.symmetric_difference(table(50, 51, 52), table(52, 53)), "v") == [(50,), (51,), (53,)]


def test_log_levels_and_messages(spark):
    lines = ["2031-05-02 09:00:00 ERROR disk two is full", "2031-05-02 09:00:01 INFO ERROR is only a word here", "2031-05-02 09:00:02 ERROR fan stopped"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    p = df.select(*[c.alias(n) for n, c in T.log_line_fields("value").items()])
    assert rows(p.filter(F.col("level") == "ERROR"), "message") == [("disk two is full",), ("fan stopped",)]


def test_access_log_ok_hits_by_endpoint(spark):
    hit = '10.0.0.{} - - [t] "{} {} HTTP/1.1" {} 7'.format
    lines = [hit(1, "GET", "/a", 200), hit(2, "PUT", "/b", 200), hit(3, "GET", "/a", 200), hit(1, "GET", "/b", 500), hit(4, "GET", "/c", 302), "no log line"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    p = df.select(*[c.alias(n) for n, c in T.access_log_fields("value").items()])
    assert rows(agg.count_by(p.filter(F.col("status") == "200"), "endpoint"), "endpoint", "count") == [("/a", 2), ("/b", 1)]
    assert p.filter(F.col("ip") == "").count() == 1  # a miss yields '' not NULL


def test_tokens_and_words(spark):
    texts = ["one  two\tthree", "\nfour\u00a0five ", "can 't stop; Won't"]
    df = spark.createDataFrame([(x,) for x in texts], "value string")
    got = sorted(r.t for r in df.select(F.explode(T.whitespace_tokens("value")).alias("t")).collect())
    assert got == sorted(tok for x in texts for tok in x.split())
    words = [r.w for r in df.select(F.explode(T.normalised_words("value")).alias("w")).collect()]
    assert "can 't" in words and "won" in words and "t" in words and "four" in words


def test_phone_function(spark):
    register_normalize_phone(spark)
    df = spark.createDataFrame([("+47 (22) 90-11-35 x8",), ("4722901135 8",), ("47.22.90.11.358",)], "s string")
    assert {r.p for r in df.selectExpr("normalize_phone(s) AS p").collect()} == {"47229011358"}


def test_neighbour_counts_trim_trailing_space(spark):
    df = spark.createDataFrame([("70 71 72 73 ",), ("71 70",), ("70 74",), ("q 70",), ("75",)], "value string")
    p = df.select(*[c.alias(n) for n, c in T.neighbour_count("value").items()])
    g = p.groupBy("id").agg(F.sum("connections").alias("c"))
    assert rows(g.dropna(), "id", "c") == [(70, 4), (71, 1), (75, 0)]


def test_similar_items_top_k_per_target(spark):
    from tidewater.operators import similarity as S

    data = [(u, i, 1 + (u * i) % 4) for u in range(12) for i in range(6) if (u + i) % 3 != 0]
    r = spark.createDataFrame(data, "user long, item long, rating long")
    both = S.similar_items(r, spark.createDataFrame([(1,), (2,)], "item long"), -1.0, 0, k=2)
    got = sorted((x.t_item, x.similar_item) for x in both.collect())
    one = sorted((x.t_item, x.similar_item) for t in (1, 2)
                 for x in S.similar_items(r, spark.createDataFrame([(t,)], "item long"), -1.0, 0, k=2).collect())
    assert got == one and len(got) == 4


def test_ranked_top_k_numbers_rows_in_order(spark):
    rows = [("a", 3), ("b", 7), ("c", 7), ("d", None), ("e", 1)]
    df = spark.createDataFrame(rows, "k string, v long")
    got = agg.ranked_top_k(df, [F.col("v").desc(), F.col("k")], 3).collect()
    assert sorted((r["rank"], r.k) for r in got) == [(1, "b"), (2, "c"), (3, "a")]
