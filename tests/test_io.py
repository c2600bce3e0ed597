"""Sources and sinks (S1–S18, K1–K13) on small files written to a temp folder."""

import os

from pyspark.sql import functions as F

from tidewater.sources import intake, readers, sinks
from tidewater.streaming import events as S
from tidewater.sources.tables import Tables


def _write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_csv_glob_with_headers_and_schema(spark, tmp_dir):
    hdr = "product_id,name,category,price,quantity\n"
    _write(os.path.join(tmp_dir, "sales_data1.csv"), hdr + "".join(f"p{i},n{i},c,{i}.5,{i}\n" for i in range(7)))
    _write(os.path.join(tmp_dir, "sales_data2.csv"), hdr + "".join(f"q{i},m{i},d,{i}.25,{i}\n" for i in range(7)))
    df = readers.read_csv(spark, os.path.join(tmp_dir, "sales_data*.csv"),
                          "product_id STRING, name STRING, category STRING, price DOUBLE, quantity INT",
                          with_file_name=True)
    assert df.count() == 14
    assert df.select("file_name").distinct().count() == 2
    rev = df.select((F.col("price") * F.col("quantity")).alias("revenue")).agg(F.sum("revenue")).first()[0]
    assert rev == sum(i * (i + 0.5) for i in range(7)) + sum(i * (i + 0.25) for i in range(7))


def test_malformed_rows_are_quarantined(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "a.csv"), "id,amount\n1,10\n2,abc\n3,30\n")
    df = readers.read_csv(spark, tmp_dir, "id INT, amount INT", keep_corrupt=True)
    good, bad = readers.split_malformed(df.cache())
    assert sorted(r.id for r in good.collect()) == [1, 3]
    assert [r._corrupt_record for r in bad.collect()] == ["2,abc"]


def test_intake_routes_a_folder_in_one_write(spark, tmp_dir):
    for folder in ("a", "b"):
        os.makedirs(os.path.join(tmp_dir, "in", folder))
    _write(os.path.join(tmp_dir, "in/a/x.csv"), 'id,name,v\n1,ab,2.5\n2,cd\n3,ef,1,9\nq,gh,2\n5,"i,j",3\n6,"kl,4\n,mn,5\n7,,\n\n8,op,x\n')
    _write(os.path.join(tmp_dir, "in/b/y.csv"), "id,name,v\n10,zz,1\n")
    _write(os.path.join(tmp_dir, "in/b/z.csv"), "")
    for _ in range(2):  # a replay leaves the same folder
        taken = intake.ingest_csv(spark, os.path.join(tmp_dir, "in"), "id BIGINT, name STRING, v DOUBLE", os.path.join(tmp_dir, "out"), required=("id",))
        assert sorted((r.id, r.name, r.v, r.folder) for r in taken.good.collect()) == [(1, "ab", 2.5, "a"), (5, "i,j", 3.0, "a"), (7, None, None, "a"), (10, "zz", 1.0, "b")]
        assert sorted(r.line for r in taken.bad.collect()) == [",mn,5.0", "2,cd", "3,ef,1,9", '6,"kl,4', "8,op,x", "q,gh,2"]
        assert sorted((r.file_path.rsplit("/", 1)[1], r.n_good, r.n_bad) for r in taken.counts().collect()) == [("x.csv", 3, 6), ("y.csv", 1, 0)]
    assert "PartitionFilters: [isnotnull(is_bad" in taken.good._jdf.queryExecution().toString()


def test_schema_applied_not_ignored(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "o.csv"), "order_id,quantity\n1,5\n2,x\n")
    df = readers.read_csv(spark, os.path.join(tmp_dir, "o.csv"), "order_id INT, quantity INT")
    assert dict(df.dtypes)["quantity"] == "int"
    assert df.filter(F.col("quantity") > 0).count() == 1  # junk → NULL, no ANSI error


def test_delimiters_encoding_and_multichar(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "u.item"), "1|Café (1995)|x\n2|Zoë|y\n", encoding="iso-8859-1")
    names = readers.read_csv(spark, os.path.join(tmp_dir, "u.item"), "id INT, title STRING, rest STRING",
                             header=False, sep="|", encoding="ISO-8859-1")
    assert {r.title for r in names.collect()} == {"Café (1995)", "Zoë"}
    _write(os.path.join(tmp_dir, "r.dat"), "1::10::4::978300760\n2::x::5::1\n")
    lines = readers.read_text(spark, os.path.join(tmp_dir, "r.dat"))
    r = readers.parse_delimited(lines, "::", [("user", "int"), ("item", "int"), ("rating", "float"), ("ts", "long")])
    assert sorted((x.user, x.item) for x in r.collect()) == [(1, 10), (2, None)]
    _write(os.path.join(tmp_dir, "g.txt"), "5 1 2\n6 1\n")
    g = readers.read_csv(spark, os.path.join(tmp_dir, "g.txt"), "a INT, b INT, c INT", header=False, sep=" ")
    assert g.count() == 2


def test_numbers_range_and_partitions(spark):
    df = readers.numbers(spark, 0, 5000, 8)
    assert df.rdd.getNumPartitions() == 8
    assert df.select(F.sum(F.col("value") * F.col("value"))).first()[0] == sum(x * x for x in range(5000))


def test_tables_text_and_dense_keys(spark, tmp_dir):
    sinks.create_database(spark, "tw_db")
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "name string, v int")
    sinks.save_table(df, "tw_db.things")
    assert readers.read_table(spark, "tw_db.things", limit=10).count() == 3
    sinks.describe(spark, "tw_db.things", "Things table", {"name": "the name"})
    keyed = sinks.with_dense_key(spark.table("tw_db.things"), ["name"], "number_id", partitions=2)
    assert sorted((r.name, r.number_id) for r in keyed.collect()) == [("a", 1), ("b", 2), ("c", 3)]
    sinks.write_text(df, os.path.join(tmp_dir, "txt"), files=1)
    assert spark.read.text(os.path.join(tmp_dir, "txt")).count() == 3
    sinks.drop_table(spark, "tw_db.things")
    assert "things" not in [t.name for t in spark.catalog.listTables("tw_db")]


def test_inserts_into_a_keyed_table(spark, tmp_dir):
    import pytest

    sinks.create_database(spark, "tw_keyed", location=os.path.join(tmp_dir, "db"))
    sinks.create_keyed_table(spark, "tw_keyed.numbers", "number_string STRING", "number_id")
    df = lambda *v: spark.createDataFrame([(x,) for x in v], "number_string string")
    state = lambda: sorted((r.number_id, r.number_string, r.load_id) for r in spark.table("tw_keyed.numbers").collect())
    put = lambda d, load: sinks.insert_with_key(d, "tw_keyed.numbers", "number_id", ["number_string"], load)
    put(df("513-849-0582", "(513) 555-1234", "513.777.8888"), "one")
    put(df().limit(0), "none")
    put(df("5138499999", "'quoted'"), "it's two")
    first = state()
    assert first == [(1, "(513) 555-1234", "one"), (2, "513-849-0582", "one"), (3, "513.777.8888", "one"), (4, "'quoted'", "it's two"), (5, "5138499999", "it's two")]
    put(df("513-849-0582", "(513) 555-1234", "513.777.8888"), "one")  # run again, though another load follows
    put(df("5138499999", "'quoted'"), "it's two")
    assert state() == first
    with pytest.raises(ValueError):
        put(df("1", "2", "3", "4"), "one")
    put(df("5138499999", "'quoted'", "6"), "it's two")  # the last load may grow
    assert [r[0] for r in state()] == [1, 2, 3, 4, 5, 6]
    sinks.drop_table(spark, "tw_keyed.numbers")


def test_rows_to_driver_are_bounded(spark):
    import pytest

    assert sorted(r.id for r in sinks.to_driver(spark.range(5), 5)) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        sinks.to_driver(spark.range(6), 5)


def test_global_rank_through_ranges(spark):
    from tidewater.operators.order import global_rank

    rows = [(i % 5, i) for i in range(500)] + [(None, -1)]
    df = spark.createDataFrame(rows, "k int, v long").repartition(7)
    got = global_rank(df, F.col("k").desc_nulls_last(), "v", partitions=9).collect()
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r.k, r.v) for r in sorted(got, key=lambda r: r["rank"])] == want and sorted(r["rank"] for r in got) == list(range(1, 502))
    assert len({r["rank"] for r in global_rank(df.where("k = 1").select("k"), "k").collect()}) == 100
    assert global_rank(df.limit(0), "k").collect() == []


def test_event_json_roundtrip_and_late_rows(spark, tmp_dir):
    inp = os.path.join(tmp_dir, "in")
    os.makedirs(inp)
    # five one-file micro-batches; the last file carries a row for a window that the
    # watermark has already closed
    batches = [
        ['{"event_type": "order", "timestamp": "2026-01-01T10:00:00.000000Z"}'],
        ['{"event_type": "navigation", "timestamp": "2026-01-01T12:00:00.000000Z"}'],
        ['{"event_type": "order", "timestamp": "2026-01-02T13:00:00.000000Z"}', "not json"],
        ['{"event_type": "order", "timestamp": "2026-01-03T13:00:00.000000Z"}'],
        ['{"event_type": "order", "timestamp": "2026-01-01T09:00:00.000000Z"}'],
    ]
    for i, lines in enumerate(batches):
        _write(os.path.join(inp, f"part-{i}.json"), "\n".join(lines) + "\n")
        os.utime(os.path.join(inp, f"part-{i}.json"), (1_000_000 + i, 1_000_000 + i))
    stream = S.windowed_counts(S.read_event_stream(spark, inp, max_files=1), "1 day", "1 hour")
    S.run_to_files(stream, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"), mode="append")
    res = spark.read.parquet(os.path.join(tmp_dir, "out"))
    got = sorted((str(r.window_start.date()), r.event_type, r.n) for r in res.collect())
    # the late 09:00 order of Jan 1 arrives after the Jan 1 window was closed → dropped;
    # the Jan 3 window is still open (its end is past the watermark) → not emitted yet
    assert got == [("2026-01-01", "navigation", 1), ("2026-01-01", "order", 1), ("2026-01-02", "order", 1)]
    # update mode emits every change per batch; the changelog folds to the latest row per key
    S.run_to_changelog(
        S.windowed_counts(S.read_event_stream(spark, inp, max_files=1)),
        os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "ck2"), mode="update")
    log = S.latest_per_key(spark, os.path.join(tmp_dir, "log"), ["window_start", "window_end", "event_type"])
    assert log.filter("event_type = 'navigation'").first().n == 1
    bad = S.parse_events(spark.read.text(inp)).filter(~F.col("is_valid"))
    assert bad.count() == 1
    kinds = S.read_event_stream(spark, inp).filter("is_valid").select(
        F.to_json(F.struct(S.event_kind(F.col("event_type")).alias("kind"), "timestamp")).alias("value"))
    q = S.publish_stream(kinds, os.path.join(tmp_dir, "ck4"), path=os.path.join(tmp_dir, "pub"), available_now=True)
    q.awaitTermination()
    assert spark.read.text(os.path.join(tmp_dir, "pub")).count() == 5


def test_quarantine_reads_once_and_replays(spark, tmp_dir):
    inp, out, ck = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    os.makedirs(inp)
    at = "2026-01-01T10:00:0{}Z"
    files = [
        [f'{{"event_id": 1, "event_type": "order", "timestamp": "{at.format(1)}"}}', "no json"],
        ['{"event_id": 2, "event_type": "order", "timestamp": "yesterday"}'],
        [f'{{"event_id": 3, "timestamp": "{at.format(3)}"}}', f'{{"event_id": 4, "event_type": "view", "timestamp": "{at.format(4)}"}}'],
    ]
    for i, lines in enumerate(files):
        _write(os.path.join(inp, f"part-{i}.json"), "\n".join(lines) + "\n")
        os.utime(os.path.join(inp, f"part-{i}.json"), (1_000_000 + i, 1_000_000 + i))

    def state(good, bad):
        return sorted((r.event_id, r.event_type, r.batch_id) for r in good.collect()), sorted((r.raw, r.batch_id) for r in bad.collect())

    first = state(*S.run_with_quarantine(S.read_event_stream(spark, inp, max_files=1), out, ck))
    assert first[0] == [(1, "order", 0), (4, "view", 2)]
    assert first[1] == sorted([("no json", 0), (files[1][0], 1), (files[2][0], 2)])
    # a batch that was written but not committed is written again, over its own folder
    os.remove(os.path.join(ck, "commits", "2"))
    again = os.path.join(ck, "commits", ".2.crc")
    if os.path.exists(again):
        os.remove(again)
    assert state(*S.run_with_quarantine(S.read_event_stream(spark, inp, max_files=1), out, ck)) == first
    assert os.path.exists(os.path.join(ck, "commits", "2"))
    assert sorted(os.listdir(os.path.join(out, "batch_id=1"))) == ["._SUCCESS.crc", "_SUCCESS", "is_valid=false"]


def test_ordered_publishing_keeps_small_batches_on_time(spark, tmp_dir):
    from datetime import datetime, timedelta

    start = datetime(2026, 1, 1)
    rows = [(i, i % 7, "view", start + timedelta(minutes=(i * 7919) % 5000), 1.0) for i in range(3000)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, ts timestamp_ntz, value double")
    S.publish_batch(events, os.path.join(tmp_dir, "in"), files=6)
    times = []
    for name in sorted(n for n in os.listdir(os.path.join(tmp_dir, "in")) if n.startswith("part-")):
        path = os.path.join(tmp_dir, "in", name)
        times.append((os.path.getmtime(path), [r.ts for r in S.parse_events(spark.read.text(path)).collect()]))
    assert len(times) == 6 and [t for t, _ in times] == sorted({t for t, _ in times})
    assert all(max(a) <= min(b) for (_, a), (_, b) in zip(times, times[1:]))
    stream = S.windowed_counts(S.read_event_stream(spark, os.path.join(tmp_dir, "in"), max_files=1), "1 hour", "10 minutes")
    S.run_to_files(stream, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"))
    got = {r.window_start: r.n for r in spark.read.parquet(os.path.join(tmp_dir, "out")).collect()}
    want = {}
    for r in rows:
        hour = r[3].replace(minute=0)
        want[hour] = want.get(hour, 0) + 1
    last = max(r[3] for r in rows) - timedelta(minutes=10)
    assert got == {h: n for h, n in want.items() if h + timedelta(hours=1) <= last}


def test_hot_user_sessions_are_stitched_over_slots(spark, tmp_dir):
    import random
    from datetime import datetime, timedelta

    r = random.Random(3)
    start, rows, at = datetime(2026, 1, 1), [], 0
    for i in range(4000):  # one user with a third of the events and more; gaps of exactly 30 minutes too
        at += r.choice([0, 20, 60, 400, 1799, 1800, 1801, 5000])
        rows.append((i, 1 if i % 2 else r.randrange(2, 9), "view", start + timedelta(seconds=at), 1.0))
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, ts timestamp_ntz, value double")
    S.publish_batch(events, os.path.join(tmp_dir, "in"), files=4)
    stream = S.hot_session_counts(S.read_event_stream(spark, os.path.join(tmp_dir, "in"), max_files=1))
    S.run_to_files(stream, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"))
    got = sorted(tuple(x) for x in spark.read.parquet(os.path.join(tmp_dir, "out")).collect())
    sessions, gap = [], timedelta(minutes=30)
    for user in range(1, 9):
        open_ = None
        for ts in sorted(x[3] for x in rows if x[1] == user):
            if open_ and ts < open_[2]:
                open_[2], open_[3] = ts + gap, open_[3] + 1
            else:
                open_ = [user, ts, ts + gap, 1]
                sessions.append(open_)
    sessions = sorted(map(tuple, sessions))
    # nothing else, and all but the newest, which the watermark has not closed
    assert len(got) == len(set(got)) and set(got) <= set(sessions)
    closed = max(x[3] for x in rows) - timedelta(hours=12)
    assert {s for s in sessions if s[2] <= closed} <= set(got) and len(got) > 0.97 * len(sessions)


def test_persist_scope_releases_blocks(spark):
    from pyspark import StorageLevel

    from tidewater.operators.layout import persisted

    df = spark.range(1000)
    with persisted(df) as p:
        assert p.count() == 1000 and p.storageLevel == StorageLevel.MEMORY_AND_DISK
    assert df.storageLevel == StorageLevel.NONE
