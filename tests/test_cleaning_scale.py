"""Cleaning computes each column once, and plain dates without the parser."""

import pytest
from pyspark.sql import functions as F

from tidewater.functions import clean as C
from tidewater.plans import cleaning, jobs
from tidewater.sources import intake


@pytest.mark.parametrize("job, ddl", [(cleaning.clean_orders, jobs.RAW_ORDERS), (cleaning.clean_customers, jobs.RAW_CUSTOMERS), (cleaning.clean_products, jobs.RAW_PRODUCTS)])
def test_filters_do_not_repeat_the_cleaning(spark, job, ddl):
    plan = job(spark.createDataFrame([], ddl))._jdf.queryExecution().optimizedPlan()
    filters = [line for line in plan.toString().splitlines() if line.lstrip(" :+-").startswith("Filter")]
    assert filters and not any("trim(" in line or "gettimestamp" in line for line in filters)


def test_dates_and_null_tokens(spark):
    texts = ["2024-02-29", "2023-02-29", "2024/01/31", "12-31-1999", "0000-01-01", "0001-01-01", "-0044-03-15", "01-01-0000", "2024-1-1",
             "2024-01-01\n", " 2024-01-01", "13-45-2020", "99999-01-01", "2024-01-01 10:00:00", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(*[F.try_to_timestamp("t", F.lit(f)).cast("date") for f in C.DATE_FORMATS])
    got = df.select("t", C.parse_date(F.col("t")).alias("d"), plain.alias("p")).where(~F.col("d").eqNullSafe(F.col("p"))).collect()
    assert got == []
    raw = spark.createDataFrame([(x,) for x in (" NULL ", "N/A", "", "  ", " a b ", None, "NA", "na")], "s string")
    assert [r.s for r in C.tidy_strings(raw, null_tokens=True).collect()] == [None, None, None, None, "a b", None, None, "na"]


def test_folder_of_a_file(spark, tmp_dir):
    spark.createDataFrame([(1,), (2,)], "a int").write.option("header", True).csv(f"{tmp_dir}/in/one")
    taken = intake.ingest_csv(spark, f"{tmp_dir}/in", "a INT", f"{tmp_dir}/out")
    assert {r.folder for r in taken.good.collect()} == {"one"}
