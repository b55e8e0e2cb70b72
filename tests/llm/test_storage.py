from pyspark.sql import functions as F

from lakeops.llm.storage import bounded_sample


def test_the_sample_is_the_smallest_hashes(spark):
    rows = spark.range(20_000).withColumn("order", F.xxhash64("id"))
    want = [r.id for r in rows.orderBy("order").limit(50).collect()]
    assert [r.id for r in bounded_sample(rows, "order", 50).collect()] == want
    for n in (51, 90, 129, 130, 200):  # a little more than the sample
        few = spark.range(n).withColumn("order", F.xxhash64("id"))
        assert [r.id for r in bounded_sample(few, "order", 50).collect()] == [r.id for r in few.orderBy("order").limit(50).collect()]
    assert bounded_sample(rows, "order", 30_000).count() == 20_000 and bounded_sample(rows.limit(0), "order", 5).count() == 0
