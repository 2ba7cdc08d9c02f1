"""Daily usage figures over the interaction log as it grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """Stream a table of the data folder; it may be one file or a folder of files.

    The last letter is a pattern so that the file source takes either.
    """
    path = f"{folder}/{name}.parque[t]"
    return spark.readStream.schema(schema).parquet(path)


def usage_daily_stream(log: DataFrame, late: str = "1 hour") -> DataFrame:
    """Per closed day: questions, mean response time, satisfaction.

    A day closes when the log has moved `late` past its end; rows later than that are
    dropped, and the state kept is one row per open day.
    """
    up = F.count(F.when(F.col("thumbs_up"), 1))
    return (
        log.withWatermark("timestamp", late)
        .groupBy(F.window("timestamp", "1 day").alias("w"))
        .agg(
            F.count(F.lit(1)).alias("questions_asked"),
            F.round(F.avg("response_time_seconds"), 6).alias("avg_response_time"),
            F.round(F.try_divide(up, F.count(F.lit(1))), 6).alias("satisfaction_rate"),
        )
        .select(F.to_date("w.start").alias("date"), "questions_asked", "avg_response_time", "satisfaction_rate")
    )


def run_usage_daily(log: DataFrame, path: str, checkpoint: str, late: str = "1 hour") -> None:
    """Process what is there, append closed days to the table at `path`, then stop."""
    query = (
        usage_daily_stream(log, late)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
