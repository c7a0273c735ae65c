from pyspark.sql import functions as F

from folium.streaming import maintenance


def test_statuses_follow(spark, tmp_path):
    reviews = f"file://{tmp_path}/reviews"
    spark.createDataFrame([(1, "pending", 1), (1, "valid", 3), (1, "rejected", 2), (2, "valid", 1)], "question_id long, status string, s long").select("question_id", "status", F.timestamp_seconds("s").alias("validated_at")).write.parquet(reviews)
    rows = spark.readStream.schema("question_id long, status string, validated_at timestamp").parquet(reviews)
    for name, frame in (("newest", maintenance.newest_status(rows)), ("rates", maintenance.review_rates(rows))):
        frame.writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination(120)
    assert sorted((r["question_id"], r["status"]) for r in spark.table("newest").collect()) == [(1, "valid"), (2, "valid")]
    assert sorted((r["status"], r["n"]) for r in spark.table("rates").collect()) == [("pending", 1), ("rejected", 1), ("valid", 2)]
