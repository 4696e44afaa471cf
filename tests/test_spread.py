from linkweave.plans.queries import cleaned


def test_cleaning_is_spread(spark, sf):
    assert spark.read.parquet(f"{sf}/part.parquet").rdd.getNumPartitions() == 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert cleaned(spark, sf, 1).rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
