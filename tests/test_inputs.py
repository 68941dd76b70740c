"""The given tables as streams."""

from pyspark.sql import functions as F

from contract import inputs as inp


def test_a_large_slice_is_many_tasks(spark, folder):
    """A slice is a batch; it comes in files of limited size, and all of its rows in that batch."""
    rows = 3 * inp.ROWS_PER_FILE
    made = spark.range(2 * rows).withColumn("slice", F.when(F.col("id") < rows, 0).otherwise(1))
    stream = inp.streamed(made, F.col("slice"), "stream-large", 2)
    seen = []

    def write(batch, batch_id):
        scanned = batch.select(F.input_file_name()).distinct().count()
        seen.append((scanned, *batch.agg(F.count("*"), F.min("slice"), F.max("slice")).first()))

    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint").trigger(
        availableNow=True).start().awaitTermination()
    assert [s[1:] for s in seen] == [(rows, 0, 0), (rows, 1, 1)]
    assert all(s[0] >= 3 for s in seen)
