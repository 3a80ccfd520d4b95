from pyspark.sql import functions as F

from orgmill.streaming import report, transitions


def test_entities_of_a_part_are_one_state_value_and_one_row(spark, tmp_path):
    source, target, marks = (str(tmp_path / x) for x in ("in", "out", "marks"))
    provider = "spark.sql.streaming.stateStore.providerClass"
    before, sizes = spark.conf.get(provider), []
    spark.conf.set(provider, transitions.PROVIDER)
    add = report.keep_totals(target)

    def watched(batch, number):
        sizes.append(batch.count())
        add(batch, number)

    try:
        for version, state in ((1, "APPROVED"), (3, "REJECTED"), (2, "APPROVED")):
            spark.range(2000).select("id", F.lit(version).cast("long").alias("version"), F.lit(state).alias("state"), F.lit(None).cast("string").alias("last_error"), F.col("id").alias("completeness"), F.lit(None).cast("long").alias("source_confidence")).write.mode("append").parquet(source)
            stream = report.changes(spark.readStream.schema("id long, version long, state string, last_error string, completeness long, source_confidence long").parquet(source))
            query = stream.writeStream.outputMode("update").foreachBatch(watched).option("checkpointLocation", marks).trigger(availableNow=True).start()
            query.awaitTermination()
    finally:
        spark.conf.set(provider, before)
    assert max(sizes) <= report.BUCKETS < 2000  # a row and a state value for each entity before
    assert query.lastProgress.stateOperators[0].numRowsTotal <= 2 * report.BUCKETS  # Spark counts each value twice
    found = report.report(spark, target).first()
    assert (found["discovered"], found["approved"], found["rejected"], found["mean_completeness"], found["mean_confidence"]) == (2000, 0, 2000, 1000, 0)
