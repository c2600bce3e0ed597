"""Generated ranges of any length."""

from tidewater.plans import files_q


def test_range_squares_beyond_bigint(spark, tmp_dir):
    n = 3_100_000  # n³/3 is above 2⁶³
    spark.range(n).withColumnRenamed("id", "o_orderkey").write.parquet(f"{tmp_dir}/orders.parquet")
    row = files_q.range_squares(spark, tmp_dir).first()
    assert (row.n, int(row.squares), row.partitions) == (n, (n - 1) * n * (2 * n - 1) // 6, 8)
    assert files_q.squares_of_range(spark, 1000, 8).schema["squares"].dataType.simpleString() == "bigint"
