from pyspark.sql import functions as F

from faremill.contracts import TRIP_CONTRACT
from faremill.sinks.tables import write_table


def test_a_partition_without_rows_goes_only_where_it_was_asked(spark):
    spark.sql("DROP TABLE IF EXISTS emptied")
    rows = spark.createDataFrame([(1, 2023, 1), (2, 2023, 2), (3, 2023, 7)], "n long, year int, month int")
    put = dict(contract=TRIP_CONTRACT, comment="", partition_by=("year", "month"))
    write_table(rows, "emptied", **put)
    write_table(rows.where("n = 1"), "emptied", **put, replace_partitions=True, emptied=F.col("month") <= 6)
    assert sorted(r.n for r in spark.table("emptied").collect()) == [1, 3]
    write_table(rows.where("n = 9"), "emptied", **put, replace_partitions=True, emptied=F.col("month") <= 6)
    assert sorted(r.n for r in spark.table("emptied").collect()) == [3]
    spark.sql("DROP TABLE emptied")
