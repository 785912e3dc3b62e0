from pyspark.sql import functions as F

from tallyhouse.llm.common import numbered


def test_numbers_are_unique_and_the_same_in_every_scan(spark, tmp_path):
    spark.range(1000).repartition(7).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    twice = table.select("id", F.explode(F.array(F.lit(1), F.lit(2))).alias("x"))
    for df in (table, table.where("id > 10"), twice, table.union(table), spark.range(50), table.withColumn("_ROW", F.lit(1))):
        rows, name = numbered(df, "t")
        assert rows.columns == [*df.columns, name]
        first = {tuple(r) for r in rows.collect()}
        assert len({r[-1] for r in first}) == df.count()
        assert first == {tuple(r) for r in rows.collect()}
    path = str(tmp_path / "t")
    assert numbered(table, "t")[0].inputFiles()[0].split("/part-")[0].endswith(path)  # a scan is not copied
