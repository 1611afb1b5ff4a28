"""The log of collection runs: one row a source, token and try, and what can be told from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.sources.files import active_only

RUN = "seq long, run_date date, source string, token string, status string, n_jobs long, http_status int, error string"
KEY = ["source", "token"]


def log_run(rows: DataFrame, path: str) -> None:
    """Append rows to the log; messages are cut to 200 characters, as a log line has to stay readable."""
    rows.withColumn("error", F.substring("error", 1, 200)).write.mode("append").parquet(path)


def last_rows(runs: DataFrame, keys: list[str], only_ok: bool = False) -> DataFrame:
    """The row written last (greatest seq) of each key, of any status or of the successful ones; a row without a seq is the oldest, and between equal ones the greatest holds."""
    if only_ok:
        runs = runs.where("status = 'ok'")
    rest = [c for c in runs.columns if c not in keys]
    return runs.groupBy(*keys).agg(F.max(F.struct(F.coalesce("seq", F.lit(-1)).alias("_order"), *rest)).alias("r")).select(*keys, *[F.col("r")[c].alias(c) for c in rest])


def daily_totals(runs: DataFrame, days: DataFrame) -> DataFrame:
    """(run_date, raw_total) of each of `days` (run_date): jobs of the last successful try of each key; null where nothing was collected."""
    last = last_rows(runs, ["run_date", *KEY], only_ok=True)
    totals = last.groupBy("run_date").agg(F.sum("n_jobs").alias("raw_total"))
    return days.select("run_date").distinct().join(totals, "run_date", "left").select("run_date", F.nullif("raw_total", F.lit(0)).alias("raw_total"))


def health_problems(runs: DataFrame, active: DataFrame, today, n_now: int | None = None, n_before: int | None = None) -> DataFrame:  # noqa: ANN001
    """(rule, source, token, detail): what is wrong with the collection, one row a problem and none if all is well.

    Only keys of `active` (source, token) count. `no log`: nothing was ever
    logged, and then nothing else is told; `stale`: the last day isn't `today`;
    `absent`: a key has no row on the last day; `failed`: its last row there is
    no success (an earlier failure that was made good doesn't count); `emptied`:
    it has no jobs but had some when it last succeeded before; `fell`: the
    kept postings are less than half of the day before (n_now, n_before).
    """
    spark = runs.sparkSession
    mine = active_only(runs, active)
    last_day = mine.agg(F.max("run_date")).first()[0]
    schema = "rule string, source string, token string, detail string"
    if last_day is None:
        return spark.createDataFrame([("no log", None, None, None)], schema)
    now = last_rows(mine.where(F.col("run_date") == last_day), KEY)
    before = last_rows(mine.where(F.col("run_date") < last_day), KEY, only_ok=True).select(*KEY, F.col("n_jobs").alias("n_old"))
    x = active.select(*KEY).distinct().join(now, KEY, "left").join(before, KEY, "left")
    rule = F.when(F.col("status").isNull(), "absent").when(F.col("status") != "ok", "failed").when((F.col("n_jobs") == 0) & (F.col("n_old") > 0), "emptied")
    detail = F.when(F.col("status") != "ok", F.concat_ws(" ", "status", F.coalesce(F.col("http_status").cast("string"), "error"))).when(F.col("status") == "ok", F.concat(F.lit("before: "), F.col("n_old").cast("string")))
    out = x.select(rule.alias("rule"), *KEY, detail.alias("detail")).where("rule is not null")
    whole = []
    if last_day != today:
        whole.append(("stale", None, None, f"{last_day}"))
    if n_before and n_now is not None and n_now < 0.5 * n_before:
        whole.append(("fell", None, None, f"{n_before} {n_now}"))
    return out.unionByName(spark.createDataFrame(whole, schema))
