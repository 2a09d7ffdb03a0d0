from pyspark.sql import functions as F

from faremill.functions.money import exact_avg, exact_sum


def test_cents_dont_depend_on_the_order(spark):
    df = spark.range(200_000).select((F.col("id") % 9991 * 1003 + F.lit(0.01) * (F.col("id") % 100)).alias("x"))
    want = sum(i % 9991 * 100300 + i % 100 for i in range(200_000))
    for parts in (1, 7):
        got = df.repartition(parts, F.rand(parts)).agg(exact_sum("x").alias("s")).first().s
        assert round(got * 100) == want


def test_what_is_no_amount_counts_as_null(spark):
    df = spark.sql("SELECT * FROM VALUES (1.5D), (double('NaN')), (double('Infinity')), (1e300D), (NULL) AS t(x)")
    assert tuple(df.agg(exact_sum("x"), exact_avg("x")).first()) == (1.5, 1.5)
    assert tuple(df.where("x IS NULL").agg(exact_sum("x"), exact_avg("x")).first()) == (None, None)
