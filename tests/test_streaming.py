from datetime import date

from postmill.sources.tables import exists, shared_dir, spread, stored
from postmill.streaming.ingest import ingest_available


def test_a_file_is_taken_once(spark, tmp_path):
    src, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    schema = "seen_date date, job_id string"
    spark.createDataFrame([(date(2026, 5, 4), "a"), (date(2026, 5, 4), "a"), (date(2026, 5, 4), "b")], schema).coalesce(1).write.parquet(src)

    def run():
        ingest_available(spark.readStream.schema(schema).parquet(src), out, mark, ["seen_date", "job_id"])
        return spark.read.schema(schema).parquet(out).count()

    assert run() == 2 and run() == 2
    spark.createDataFrame([(date(2026, 5, 7), "a"), (None, None)], schema).coalesce(1).write.mode("append").parquet(src)
    assert run() == 4


def test_spread_and_stored(spark):
    df = spark.range(10).coalesce(1)
    assert sorted(r["id"] for r in spread(df).collect()) == list(range(10))
    assert spread(df).rdd.getNumPartitions() > 1 and spread(spark.range(0, 10, 1, 8)).rdd.getNumPartitions() == 8
    at = f"{shared_dir(spark)}/x"
    assert not exists(spark, at)
    assert stored(df, at).count() == 10 and exists(spark, at)
