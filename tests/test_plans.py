"""Plan assertions: broadcast where proven small, pushdown/pruning reach the scan,
partition pruning on partitioned output, skew-safe shapes."""

import io
import os
from contextlib import redirect_stdout

from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewater.sources import sinks
from tidewater.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_broadcast_join_for_proven_small_dimension(spark):
    p = plan(E.queries()["customers_per_nation"](spark, SF))
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p


def test_filter_and_projection_reach_the_scan(spark):
    t = Tables(spark, SF, spread=False)
    df = t.lineitem.filter(F.col("l_quantity") > 10).select("l_orderkey", "l_quantity")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p


def test_partition_pruning_on_partitioned_output(spark, tmp_dir):
    t = Tables(spark, SF)
    out = os.path.join(tmp_dir, "by_status")
    sinks.write_parquet(t.orders.select("o_orderkey", "o_orderstatus"), out, partition_by=["o_orderstatus"])
    back = spark.read.parquet(out).filter(F.col("o_orderstatus") == "F")
    p = plan(back)
    assert "PartitionFilters: [isnotnull(o_orderstatus" in p and "(o_orderstatus#" in p
    assert back.count() == t.orders.filter("o_orderstatus = 'F'").count()


def test_aggregates_are_partial_before_shuffle(spark):
    p = plan(E.queries()["salted_count"](spark, SF), "simple")
    assert p.count("partial_") >= 2  # both salted phases pre-aggregate on the map side


def test_top_per_group_uses_group_limit(spark):
    p = plan(E.queries()["top_per_group"](spark, SF), "simple")
    assert "WindowGroupLimit" in p


def test_anti_join_written_as_anti(spark):
    p = plan(E.queries()["customers_without_urgent_orders_sql"](spark, SF), "simple")
    assert "LeftAnti" in p


def test_similar_items_reads_checkpoint_and_pairs_only_with_target(spark):
    p = plan(E.queries()["similar_items"](spark, SF), "simple")
    # the heavy pipeline ran once into the checkpoint; the report only reads those rows
    assert "Scan ExistingRDD" in p and "lineitem" not in p
    from tidewater.operators import similarity as S

    t = Tables(spark, SF)
    r = S.ratings_from_orders(t.lineitem, t.orders)
    op = plan(S.similar_items(r, S.most_rated_item(r), 0.97, 1, 10), "simple")
    assert "CartesianProduct" not in op and "NestedLoop" not in op
    # the target side is a broadcast one-row relation
    assert "TakeOrderedAndProject(limit=1" in op


def test_pivot_with_fixed_values_runs_no_job_at_build_time(spark):
    from tidewater.operators import aggregate as agg

    e = Tables(spark, SF).events
    tracker = spark.sparkContext.statusTracker()
    grp = "tw-pivot-check"
    spark.sparkContext.setJobGroup(grp, "pivot build")
    try:
        agg.pivot_sum(e, "user_id", "event_type", ["click", "view"], F.count(F.lit(1)))
        assert tracker.getJobIdsForGroup(grp) == []  # values given: no distinct-values job
        e.groupBy("user_id").pivot("event_type").count()
        assert len(tracker.getJobIdsForGroup(grp)) >= 1  # values inferred: one extra job
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_salted_join_finds_and_repeats_only_hot_keys(spark):
    from tidewater.operators.joins import hot_keys, salted_join

    t = Tables(spark, SF)
    part = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).when(F.col("l_orderkey") % 50 != 1, F.col("l_partkey")).cast("long")
    li = t.lineitem.select("l_orderkey", "l_linenumber", part.alias("k"))
    dim = t.part.select(F.col("p_partkey").alias("k"), "p_brand").where("p_brand <> 'Brand#11'")
    hot = {r.k: r.salts for r in hot_keys(li, "k", 16).collect()}
    assert hot == {1: 6}  # a third of the rows and a bit fills six parts in sixteen
    assert t.part.count() + sum(s - 1 for s in hot.values()) < 2 * t.part.count()
    for how in ("inner", "left", "left_semi", "left_anti"):
        rows = sorted(map(tuple, salted_join(li, dim, "k", 16, how=how).collect()), key=str)
        assert rows == sorted(map(tuple, li.join(dim, "k", how).select(salted_join(li, dim, "k", 16, how=how).columns).collect()), key=str)
    assert hot_keys(li.limit(0), "k", 16).collect() == [] and hot_keys(t.lineitem, "l_orderkey", 16).collect() == []


def final_plan(spark, name):
    """The plan as it ran, broadcasts off, as at a size where neither side is small."""
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        df = E.queries()[name](spark, SF)
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
        return text[text.index("Final Plan") : text.index("Initial Plan")]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_ordered_scans_read_and_shuffle_their_rows_once(spark):
    for name in ("sessions", "running_total", "lag_diff_lead"):
        p = final_plan(spark, name)
        assert p.count("FileScan parquet") == 1 and p.count("ReusedExchange") == 1, name
    p = final_plan(spark, "rolling_7d")
    assert p.count("FileScan parquet") == 1 and p.count("Exchange hashpartitioning") == 1 and "Join" not in p


def test_quality_suite_scans_each_model_once(spark):
    p = final_plan(spark, "quality_report")
    assert p.count("FileScan parquet") == 2 and p.count("Scan ExistingRDD") == 1 and "Join" not in p
