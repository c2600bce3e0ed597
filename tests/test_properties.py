"""Property tests: the skew-safe two-level operators equal the plain one-window forms,
salted aggregates equal unsalted ones, and set semantics equal Python list semantics."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import aggregate as agg
from tidewater.operators import sets, windows

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

BASE = dt.datetime(2026, 1, 1)
events = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 6 * 3600), st.integers(-50, 50)),
    min_size=1, max_size=40,
)


def _df(spark, evs):
    data = [(u, BASE + dt.timedelta(seconds=s), v, i) for i, (u, s, v) in enumerate(evs)]
    return spark.createDataFrame(data, "u string, ts timestamp_ntz, v long, eid long")


def _py_sessions(evs, gap_min=30):
    by = {}
    for i, (u, s, _) in enumerate(evs):
        by.setdefault(u, []).append((s, i))
    out = {}
    for u, lst in by.items():
        lst.sort()
        sid, prev = 0, None
        for s, i in lst:
            if prev is None or (s - prev) / 60 > gap_min:
                sid += 1
            out[i] = sid
            prev = s
    return out


@SETTINGS
@given(events)
def test_sessionize_matches_python(spark, evs):
    s = windows.sessionize(_df(spark, evs), "u", "ts", "eid", 30, chunk_seconds=1800)
    got = {r.eid: r.session_id for r in s.collect()}
    assert got == _py_sessions(evs)


@SETTINGS
@given(events)
def test_running_total_matches_plain_window(spark, evs):
    df = _df(spark, evs)
    two = windows.running_total(df, "u", "ts", F.col("v"), chunk_seconds=1200)
    w = Window.partitionBy("u").orderBy("ts").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    plain = df.withColumn("p", F.sum("v").over(w))
    a = {r.eid: r.running_total for r in two.collect()}
    b = {r.eid: r.p for r in plain.collect()}
    assert a == b


@SETTINGS
@given(events)
def test_lag_lead_matches_plain_window(spark, evs):
    df = _df(spark, evs)
    two = windows.lag_lead(df, "u", "ts", "eid", "v", chunk_seconds=900)
    w = Window.partitionBy("u").orderBy("ts", "eid")
    plain = df.select("eid", F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("n"))
    a = {r.eid: (r.prev_value, r.next_value) for r in two.collect()}
    b = {r.eid: (r.p, r.n) for r in plain.collect()}
    assert a == b


@SETTINGS
@given(events, st.integers(1, 4), st.sampled_from(["row_number", "rank", "dense_rank"]))
def test_salted_top_n_matches_plain(spark, evs, n, method):
    df = _df(spark, evs)
    order = [F.col("v").desc(), F.col("eid")] if method == "row_number" else [F.col("v").desc()]
    salted = windows.top_n_per_group(df, "u", order, n, method=method, salt_buckets=3)
    plain = windows.top_n_per_group(df, "u", order, n, method=method, salt_buckets=None)
    assert sorted((r.eid, r.rnk) for r in salted.collect()) == sorted((r.eid, r.rnk) for r in plain.collect())


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["x", "y"]), st.integers(0, 10_000)), min_size=1, max_size=60))
def test_salted_sum_equals_plain(spark, data):
    df = spark.createDataFrame([(k, v / 100, i) for i, (k, v) in enumerate(data)], "k string, v double, i long")
    money = F.col("v").cast("decimal(18,2)")
    s = agg.salted_sum_count(df, "k", money, 7, ["i"])
    p = df.groupBy("k").agg(F.count(F.lit(1)).alias("row_count"), F.sum(money).alias("total"))
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, p.select("k", "row_count", "total").collect()))


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=15),
       st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=15))
def test_subtract_matches_rdd_semantics(spark, a, b):
    da = spark.createDataFrame([(x,) for x in a], "v long")
    db = spark.createDataFrame([(x,) for x in b], "v long")
    got = Counter(r.v for r in sets.subtract_all_copies(da, db).collect())
    bs = set(b)
    assert got == Counter(x for x in a if x not in bs)
    sym = Counter(r.v for r in sets.symmetric_difference(da, db).collect())
    a_set = set(a)
    assert sym == Counter([x for x in a if x not in bs] + [x for x in b if x not in a_set])


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.text("ab", max_size=2)), min_size=1, max_size=30))
def test_keep_one_per_key_is_minimum(spark, data):
    df = spark.createDataFrame([(k, o, t) for k, o, t in data], "k long, o long, t string")
    got = {r.k: (r.o, r.t) for r in agg.keep_one_per_key(df, "k", ["o", "t"]).collect()}
    want = {}
    for k, o, t in data:
        want[k] = min(want.get(k, (o, t)), (o, t))
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 20 * 86400), st.integers(-50, 50)),
                min_size=1, max_size=40))
def test_rolling_mean_matches_plain_range_window(spark, evs):
    # include exact 7-day distances: the look-back is inclusive
    evs = evs + [(u, s + 7 * 86400, v) for u, s, v in evs[:3]]
    df = _df(spark, evs).withColumn("v", F.col("v").cast("decimal(18,2)"))
    two = windows.rolling_mean(df, "u", "ts", F.col("v"), "eid", days=7, chunk_days=7)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    w = Window.partitionBy("u").orderBy(micros).rangeBetween(-7 * 86_400_000_000, 0)
    plain = df.select("eid", F.sum("v").over(w).alias("s"), F.count("v").over(w).alias("n"))
    a = {r.eid: (r.rolling_sum, r.rolling_n) for r in two.collect()}
    b = {r.eid: (r.s, r.n) for r in plain.collect()}
    assert a == b


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 4))),
                min_size=1, max_size=40))
def test_rank_all_matches_window_functions(spark, data):
    df = spark.createDataFrame([(g, o, i) for i, (g, o) in enumerate(data)], "g string, o long, i long")
    two = windows.rank_all(df, "g", ["o"])
    w = Window.partitionBy("g").orderBy("o")
    plain = df.select("i", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"))
    assert {r.i: (r.rnk, r.dense_rnk) for r in two.collect()} == {r.i: (r.r, r.d) for r in plain.collect()}


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 6), st.integers(1, 5)), min_size=1, max_size=40))
def test_salted_item_similarity_equals_plain(spark, data):
    from tidewater.operators import similarity as S

    df = spark.createDataFrame(data, "user long, item long, rating long")
    r = df.groupBy("user", "item").agg(F.sum("rating").alias("rating"))
    a = sorted(map(tuple, S.item_similarity(r, salt_buckets=3).collect()))
    b = sorted(map(tuple, S.item_similarity(r).collect()))
    c = sorted(map(tuple, S.item_similarity(r, hot_shares=3).collect()))
    assert a == b == c


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 7), st.integers(1, 5)), min_size=1, max_size=60), st.integers(0, 4), st.sampled_from([-1.0, 0.5, 0.97]))
def test_pruned_pairs_equal_the_filtered_full_table(spark, data, min_pairs, score):
    from tidewater.operators import similarity as S

    df = spark.createDataFrame(data, "user long, item long, rating long")
    r = df.groupBy("user", "item").agg(F.sum("rating").alias("rating")).checkpoint()
    full = S.item_similarity(r).where((F.col("similarity") > score) & (F.col("num_pairs") > min_pairs))
    assert sorted(map(tuple, S.similar_pairs(r, score, min_pairs).select(full.columns).collect())) == sorted(map(tuple, full.collect()))


@SETTINGS
@given(st.lists(st.text(alphabet="0123456789-/+ ", min_size=0, max_size=12), min_size=1, max_size=60))
def test_guarded_date_parse_equals_plain_parse(spark, texts):
    from tidewater.functions import clean as C

    texts = texts + ["2024-01-05", "-2024-01-05", "2024/01/05", "01-05-2024", "2024-02-30", "0024-01-05"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    plain = F.coalesce(*[F.try_to_timestamp(F.col("s"), F.lit(f)).cast("date") for f in C.DATE_FORMATS])
    # compared inside Spark: a negative year cannot be turned into a Python date
    out = df.select(C.parse_date(F.col("s")).alias("a"), plain.alias("b"))
    assert out.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 40))),
                min_size=1, max_size=50), st.integers(1, 9))
def test_chunked_rank_all_matches_window_functions(spark, data, width):
    df = spark.createDataFrame([(g, o, i) for i, (g, o) in enumerate(data)], "g string, o long, i long")
    two = windows.rank_all(df, "g", ["o"], chunk=F.floor(F.col("o") / width))
    w = Window.partitionBy("g").orderBy("o")
    plain = df.select("i", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"))
    assert {r.i: (r.rnk, r.dense_rnk) for r in two.collect()} == {r.i: (r.r, r.d) for r in plain.collect()}


def test_clean_orders_is_idempotent(spark):
    from tidewater.plans import cleaning
    from tidewater.plans.cleaning_q import raw_orders
    from tidewater.sources.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    once = cleaning.clean_orders(raw_orders(t.lineitem, t.orders)).cache()
    as_raw = once.select(
        "order_id", "customer_id", "product_id",
        F.date_format("order_date", "yyyy-MM-dd").alias("order_date"),
        F.date_format("ship_date", "yyyy-MM-dd").alias("ship_date"),
        "quantity",
        F.col("unit_price").cast("string").alias("unit_price"),
        F.col("discount_pct").cast("string").alias("discount_pct"),
        F.col("total_amount").cast("string").alias("total_amount"),
        "payment_method", "order_status",
    )
    twice = cleaning.clean_orders(as_raw)
    assert once.count() > 0
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


@SETTINGS
@given(
    st.lists(st.integers(0, 6) | st.none(), max_size=20),
    st.lists(st.tuples(st.integers(0, 9) | st.none(), st.integers(0, 9) | st.none(), st.sampled_from(["F", "O", "P", None])), max_size=30),
)
def test_suite_counts_what_each_test_finds(spark, parents, rows):
    from tidewater.operators import quality as Q

    p = spark.createDataFrame([(x,) for x in parents], "id long")
    c = spark.createDataFrame(rows, "k long, pid long, status string")
    got = Q.run_suite([
        Q.Model("p", p, unique=["id"], not_null=["id"]),
        Q.Model("c", c, unique=["k"], not_null=["k", "status"], accepted={"status": ["F", "O"]}, relationships=[("pid", "p", "id")]),
        Q.Model("bare", p, accepted={"id": [1, 2]}),
    ])
    want = Q.run_tests([
        Q.Check("p", "id", "unique", Q.unique(p, "id")), Q.Check("p", "id", "not_null", Q.not_null(p, "id")),
        Q.Check("c", "k", "unique", Q.unique(c, "k")), Q.Check("c", "k", "not_null", Q.not_null(c, "k")),
        Q.Check("c", "status", "not_null", Q.not_null(c, "status")), Q.Check("c", "status", "accepted_values", Q.accepted_values(c, "status", ["F", "O"])),
        Q.Check("c", "pid", "relationships", Q.relationships(c, "pid", p, "id")), Q.Check("bare", "id", "accepted_values", Q.accepted_values(p, "id", [1, 2])),
    ])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4) | st.none(), st.integers(0, 3) | st.none(), st.sampled_from(["a", "b", None])), min_size=1, max_size=40), st.sampled_from(["first", "last"]))
def test_both_ways_to_keep_one_row_per_key_agree(spark, data, keep):
    from tidewater.operators.aggregate import keep_one_per_key

    df = spark.createDataFrame(data, "k long, v long, s string")
    a = keep_one_per_key(df, "k", ["v", "s"], keep).select("k", "v", "s")
    b = keep_one_per_key(df, "k", ["v", "s"], keep, near_unique=True)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@SETTINGS
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 5) | st.none()), min_size=1, max_size=60),
    st.integers(1, 4), st.booleans(),
)
def test_top_ranks_with_ties_match_window_functions(spark, data, n, dense):
    df = spark.createDataFrame([(g, o, i) for i, (g, o) in enumerate(data)], "g string, o long, i long")
    w = Window.partitionBy("g").orderBy("o")
    plain = df.withColumn("r", (F.dense_rank() if dense else F.rank()).over(w)).where(F.col("r") <= n)
    got = windows.top_ranks(df, "g", ["o"], n, dense=dense, salt_buckets=4)
    assert {r.i: r.rnk for r in got.collect()} == {r.i: r.r for r in plain.collect()} and got.count() == plain.count()
