"""Session helpers."""

from noticeflow.session import spread


def test_a_large_file_is_cut_into_more_tasks_than_cores(spark, tmp_path):
    """Tasks follow the bytes of the input, not the cores alone; the rows stay."""
    path = str(tmp_path / "some table")
    spark.range(5000).selectExpr("id", "sha2(cast(id AS string), 256) AS t").coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    cut = spread(df, 20_000)
    assert cut.rdd.getNumPartitions() > 2 * spark.sparkContext.defaultParallelism
    assert sorted(r.id for r in cut.collect()) == list(range(5000))
    assert spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
