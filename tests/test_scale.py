"""Bounds that keep a task's share from growing with the whole table."""

from pyspark.sql import functions as F

from reviewloom.operators import recommend
from reviewloom.plans import vector_queries, work_queries


def reviews(spark):
    rows = [(f"u{n % 40}", f"i{n % 90}", float(n % 5 + 1), n, n % 7, "only") for n in range(1_200)]
    return spark.createDataFrame(rows, "user_id string, parent_asin string, rating double, timestamp bigint, helpful_vote int, category string")


def test_one_category_is_dealt_to_several_tasks(spark, monkeypatch):
    tasks, plain = [], work_queries.write_dataset

    def counted(df, *args, **more):
        tasks.append(df.select(F.spark_partition_id().alias("p")).distinct().count())
        return plain(df, *args, **more)

    monkeypatch.setattr(work_queries.dt, "reviews", lambda session, sf: reviews(session))
    monkeypatch.setattr(work_queries, "write_dataset", counted)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which would join small shares into one task
    try:
        row = work_queries.rows_per_part(spark, "").first()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert tasks[0] > 1 and tuple(row) == ("only", 1_200, True, True)


def test_factor_blocks_follow_the_samples(spark):
    assert [recommend.factor_blocks(n) for n in (0, 40_000_000, 400_000_000)] == [10, 10, 100]


def test_star_counts_are_written_once(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(vector_queries.dt, "reviews", lambda session, sf: asked.append(sf) or reviews(session))
    users, items = vector_queries.star_histograms(spark, "")
    assert len(asked) == 1 and users.count() == 40 and items.count() == 90
    for made in (users, items):
        assert made.inputFiles() and "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
