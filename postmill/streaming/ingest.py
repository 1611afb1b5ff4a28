"""Daily increments as a stream: new files are taken once, with the same functions as the batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.sources.tables import exists, shared_dir


def ingest_available(source: DataFrame, out: str, checkpoint: str, keys: list[str]) -> None:
    """Append the new rows of a streaming source to `out`, each key once over all batches; what was taken is kept in `checkpoint`.

    A batch that is run again after a failure writes to its own folder, so its
    rows are replaced and not doubled. Of earlier batches only the keys are read.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark, new = batch.sparkSession, batch.dropDuplicates(keys)
        if exists(spark, out):
            old = spark.read.schema(batch.select(*keys).schema.add("batch", "integer")).parquet(out).where(F.col("batch") != number)
            new = new.join(old.select(*keys), keys, "left_anti")
        new.write.mode("overwrite").parquet(f"{out}/batch={number}")

    source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stream_daily_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active postings per day, counted from the daily rows as they arrive; a file is taken once."""
    schema = spark.read.parquet(f"{sf_dir}/daily_active.parquet").schema
    base = shared_dir(spark)
    source = spark.readStream.schema(schema).parquet(f"{sf_dir}/daily_active.parquet*").where("job_id is not null")
    ingest_available(source, f"{base}/rows", f"{base}/checkpoint", ["seen_date", "job_id"])
    rows = spark.read.schema(schema).parquet(f"{base}/rows").distinct()
    return rows.groupBy("seen_date").agg(F.count(F.lit(1)).alias("n_active"))


QUERIES = {"stream_daily_active": stream_daily_active}
SQL = {"stream_daily_active": "SELECT seen_date, count(DISTINCT job_id) AS n_active FROM daily_active WHERE job_id IS NOT NULL GROUP BY 1"}
