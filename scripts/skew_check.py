"""Measure how the skew-safe operators spread a hot key, from Spark's event log.

    python scripts/skew_check.py [sf_dir] [out_json]

A skewed copy of ``events`` is derived with Spark (one user receives a third of all
rows), then each operator is run next to its plain one-window / unsalted form.  For
every run the event log (written to a fresh scratch folder) gives, per stage, the
records read by each task; we report the largest single-task share of a stage's
records over the run's shuffle stages, and check that both forms return the same rows.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out_json = sys.argv[2] if len(sys.argv) > 2 else None
    scratch = tempfile.mkdtemp(prefix="tw-skew-")
    logs = os.path.join(scratch, "eventlog")
    os.makedirs(logs)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")  # measure raw spread
        # AQE's own skew-join split would also divide the hot user's join partition; it is
        # off here so the operators' explicit splitting is measured on its own.
        .config("spark.sql.adaptive.skewJoin.enabled", "false")
        # At 100 TB the self-join is a sort-merge join on user; at this size Spark would
        # broadcast one side, which hides the hot key.  Broadcasts are off for the measurement.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", logs)
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    from tidewater.operators import aggregate as agg
    from tidewater.operators import joins as J
    from tidewater.operators import similarity as S
    from tidewater.operators import windows as W

    ev = spark.read.parquet(f"{sf}/events.parquet")
    # Skewed copy: every third event is re-assigned to user 0 (a third of all rows).
    skewed = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    skewed.repartition(8).write.mode("overwrite").parquet(f"{scratch}/events_skewed")
    e = spark.read.parquet(f"{scratch}/events_skewed")

    def plain_sessions(df):
        w = Window.partitionBy("user_id").orderBy("ts", "event_id")
        sec = F.col("ts").cast("timestamp").cast("long")
        d = df.withColumn("sec", sec).withColumn("prev", F.lag("sec").over(w))
        flag = F.when(F.col("prev").isNull() | ((F.col("sec") - F.col("prev")) / 60 > 30), 1).otherwise(0)
        return d.withColumn("session_id", F.sum(flag).over(w.rowsBetween(Window.unboundedPreceding, 0))).select(
            "event_id", "session_id"
        )

    def plain_running(df):
        w = Window.partitionBy("user_id").orderBy("ts").rangeBetween(Window.unboundedPreceding, 0)
        return df.select("event_id", F.sum(F.col("value").cast("decimal(18,2)")).over(w).alias("running_total"))

    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    o = spark.read.parquet(f"{sf}/orders.parquet")
    # Skewed ratings: a third of the order lines are re-assigned to customer 0.
    o_sk = o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey")))
    ratings = S.ratings_from_orders(li, o_sk).checkpoint(eager=True)

    cases = {
        "sessions/plain": lambda: plain_sessions(e),
        "sessions/two_level": lambda: W.sessionize(e.select("event_id", "user_id", "ts"), "user_id", "ts", "event_id",
                                                   30, chunk_seconds=86400).select("event_id", "session_id"),
        "running_total/plain": lambda: plain_running(e),
        "running_total/two_level": lambda: W.running_total(
            e.select("event_id", "user_id", "ts", "value"), "user_id", "ts",
            F.col("value").cast("decimal(18,2)"), chunk_seconds=86400).select("event_id", "running_total"),
        "top_per_group/plain": lambda: W.top_n_per_group(
            e, "user_id", [F.col("value").desc(), F.col("event_id")], 2, salt_buckets=None).select("event_id", "rnk"),
        "top_per_group/salted": lambda: W.top_n_per_group(
            e, "user_id", [F.col("value").desc(), F.col("event_id")], 2, salt_buckets=16).select("event_id", "rnk"),
        "dedup/plain": lambda: e.withColumn(
            "rn", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))).filter("rn = 1")
            .select("user_id", "event_id"),
        "dedup/min_by": lambda: agg.keep_one_per_key(e.select("user_id", "event_id"), "user_id", ["event_id"]),
        "item_similarity/plain": lambda: S.item_similarity(ratings),
        "item_similarity/hot_salted": lambda: S.item_similarity(ratings, hot_shares=64),
    }
    # Skewed lines: a third of them are of part 1.
    lines = li.select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_partkey")).cast("long").alias("k"))
    parts = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("k"), "p_brand")
    cases["salted_join/plain"] = lambda: lines.join(parts, "k").select("l_orderkey", "l_linenumber", "p_brand")
    cases["salted_join/found_hot"] = lambda: J.salted_join(lines, parts, "k", 64).select("l_orderkey", "l_linenumber", "p_brand")
    # A third of the events are of one user, and tied at the top of it.
    tied = e.select("user_id", "event_id", F.when(F.col("user_id") == 0, F.lit(0)).otherwise(F.col("event_id") % 7).alias("v"))
    cases["top_ranks/plain"] = lambda: tied.withColumn("rnk", F.rank().over(Window.partitionBy("user_id").orderBy("v"))).where("rnk <= 3").select("event_id", "rnk")
    cases["top_ranks/by_value"] = lambda: W.top_ranks(tied, "user_id", ["v"], 3, salt_buckets=64).select("event_id", "rnk")
    sc = spark.sparkContext
    groups, results = {}, {}
    for name, build in cases.items():
        sc.setJobGroup(name, name)
        rows = build().collect()
        results[name] = sorted(tuple(r) for r in rows)
        groups[name] = [s for j in sc.statusTracker().getJobIdsForGroup(name)
                        for s in (sc.statusTracker().getJobInfo(j).stageIds if sc.statusTracker().getJobInfo(j) else [])]
    same = {
        op: results[f"{op}/plain"] == results[[k for k in cases if k.startswith(op + "/") and not k.endswith("plain")][0]]
        for op in ("sessions", "running_total", "top_per_group", "dedup", "item_similarity", "salted_join", "top_ranks")
    }
    spark.stop()

    per_stage: dict[int, list[int]] = {}
    written: dict[int, list[int]] = {}
    for path in glob.glob(os.path.join(logs, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev_ = json.loads(line)
                if ev_.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = ev_.get("Task Metrics") or {}
                recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                if recs:
                    per_stage.setdefault(ev_["Stage ID"], []).append(recs)
                w = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
                if w:
                    written.setdefault(ev_["Stage ID"], []).append(w)
    def worst_share(metric, stages):
        worst = 0.0
        for st in stages:
            t = metric.get(st)
            if t and sum(t) > 1000:
                worst = max(worst, max(t) / sum(t))
        return round(worst, 3)

    report = {name: worst_share(per_stage, st) for name, st in groups.items()}
    report_w = {name: worst_share(written, st) for name, st in groups.items()}
    out = {"max_single_task_share_of_records_read": report,
           "max_single_task_share_of_records_written": report_w, "same_rows_as_plain": same,
           "hot_key_share_of_rows": "1/3", "shuffle_partitions": 32, "aqe_skew_join": False, "broadcast_joins": False, "sf_dir": sf}
    if os.environ.get("SKEW_DEBUG"):
        for name, st in groups.items():
            for x in st:
                if x in written or x in per_stage:
                    r, w = per_stage.get(x, []), written.get(x, [])
                    print(name, x, "read", sum(r), max(r or [0]), "written", sum(w), max(w or [0]), len(w))
    print(json.dumps(out, indent=2))
    if out_json:
        with open(out_json, "w") as f:
            json.dump(out, f, indent=2)


if __name__ == "__main__":
    main()
