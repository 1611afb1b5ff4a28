"""File sources and sinks: JSON lines, board files, landing, published snapshots."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postmill.functions.text import html_to_text, redact, stable_id
from postmill.sources.tables import exists

#: Files named <source>__<token>.json; a list of jobs under "jobs", or a bare list.
LISTED = (
    "jobs array<struct<id:string,title:string,company_name:string,absolute_url:string,location:struct<name:string>,first_published:string,updated_at:string,"
    "departments:array<struct<name:string>>,offices:array<struct<name:string,location:string>>,content:string,internal_job_id:string>>"
)
BARE = (
    "array<struct<id:string,text:string,hostedUrl:string,categories:struct<location:string,allLocations:array<string>,department:string,team:string>,country:string,createdAt:bigint,"
    "descriptionPlain:string,description:string,lists:array<struct<text:string,content:string>>,additionalPlain:string,salaryRange:struct<currency:string,interval:string,min:double,max:double>>>"
)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of a JSON-lines file or folder. A missing path is an empty table; blank and broken lines are skipped; BOM and CRLF don't matter."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    empty = spark.createDataFrame([], schema)
    lines = spark.read.text(path, lineSep="\n").select(F.regexp_replace("value", r"^\ufeff|\r$", "").alias("value"))
    with_bad = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in empty.schema), "_bad string"])
    rows = lines.where("trim(value) <> ''").select(F.from_json("value", with_bad, {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return rows.where("r is not null and r._bad is null").select(*[F.col("r")[f.name].alias(f.name) for f in empty.schema])


#: Characters that some readers take for line ends.
_LINE_ENDS = ("\u2028", "\u2029", "\u0085")


def json_lines(df: DataFrame) -> DataFrame:
    """(value): each row as one line of JSON. Nulls are kept; letters stay as they are but for line ends of other conventions."""
    line = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    for c in _LINE_ENDS:
        line = F.replace(line, F.lit(c), F.lit(f"\\u{ord(c):04x}"))
    return df.select(line.alias("value"))


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    json_lines(df).write.mode("append" if append else "overwrite").text(path)


def write_csv(df: DataFrame, path: str, headers: dict[str, str] | None = None) -> None:
    """CSV with a header row, optionally under other names; every part begins with a BOM, as spreadsheets expect."""
    names = headers or {}
    first = df.columns[0]
    out = df.select(*[F.col(c).alias(("\ufeff" if c == first else "") + names.get(c, c)) for c in df.columns])
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def _falls(*cols):  # noqa: ANN002, ANN202
    """First value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


_SALARY = "struct<currency:string,interval:string,min:double,max:double>"


def _listed_job(j):  # noqa: ANN001, ANN202
    """A job of a listed board in the common form; its text is HTML that is escaped once more."""
    return F.struct(
        j["id"].alias("source_job_id"), j["absolute_url"].alias("url"), F.trim(j["title"]).alias("title"), F.nullif(j["company_name"], F.lit("")).alias("company"),
        F.coalesce(j["location"]["name"], F.lit("")).alias("location"),
        F.array_join(F.filter(F.transform(j["offices"], lambda o: _falls(o["location"], o["name"])), lambda x: x.isNotNull()), "; ").alias("location_extra"), F.lit(None).cast("string").alias("country_code"),
        F.array_join(F.transform(j["departments"], lambda d: F.coalesce(d["name"], F.lit(""))), "; ").alias("department"), F.substring(_falls(j["first_published"], j["updated_at"]), 1, 10).alias("posted_date"),
        F.lit(None).cast("string").alias("plain"), F.lit(None).cast("string").alias("body"), F.lit(None).cast("string").alias("lists"), F.lit(None).cast("string").alias("more"), j["content"].alias("escaped"), F.lit(None).cast(_SALARY).alias("salary"),
    )


def _bare_job(j):  # noqa: ANN001, ANN202
    """A job of a bare board in the common form: plain text, or HTML; lists in HTML, joined so that each begins a line."""
    lists = F.transform(j["lists"], lambda x: F.concat(F.coalesce(x["text"], F.lit("")), F.lit("<br>"), F.coalesce(x["content"], F.lit(""))))
    return F.struct(
        j["id"].alias("source_job_id"), j["hostedUrl"].alias("url"), F.trim(j["text"]).alias("title"), F.lit(None).cast("string").alias("company"), F.coalesce(j["categories"]["location"], F.lit("")).alias("location"),
        F.array_join(F.coalesce(j["categories"]["allLocations"], F.array()), "; ").alias("location_extra"), j["country"].alias("country_code"), _falls(j["categories"]["department"], j["categories"]["team"]).alias("department"),
        F.date_format(F.timestamp_millis(j["createdAt"]), "yyyy-MM-dd").alias("posted_date"),
        F.nullif(j["descriptionPlain"], F.lit("")).alias("plain"), j["description"].alias("body"), F.array_join(F.coalesce(lists, F.array()), "<p>").alias("lists"), F.nullif(F.trim(j["additionalPlain"]), F.lit("")).alias("more"),
        F.lit(None).cast("string").alias("escaped"), j["salaryRange"].alias("salary"),
    )


def read_boards(spark: SparkSession, path: str) -> DataFrame:
    """Postings of all board files below `path` (.../<day>/<source>__<token>.json) in one schema, the first of each (day, source, id) by file and place.

    Each file is read and parsed once. A file that is no JSON, or of another
    form, gives no rows. A JSON document has no line structure, so one file
    (the board of one company on one day) is one row until it is unpacked.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    day = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4}-\d{2}-\d{2})/", 1)
    raw = raw.select(F.ltrim("value").alias("value"), name.alias("file"), F.nullif(day, F.lit("")).cast("date").alias("seen_date"))
    is_object = F.col("value").startswith("{")
    jobs = F.when(is_object, F.transform(F.from_json("value", LISTED)["jobs"], _listed_job)).otherwise(F.transform(F.from_json("value", BARE), _bare_job))
    rows = raw.select("file", "seen_date", F.posexplode(jobs).alias("pos", "j")).select("file", "seen_date", "pos", "j.*").where("source_job_id is not null")
    source = F.substring_index("file", "__", 1)
    token = F.regexp_replace(F.expr("substring(file, instr(file, '__') + 2)"), r"\.json$", "")
    # only the first of each day, source and id is unpacked further: the texts of the others never reach Python
    rows = rows.withColumn("source", source).withColumn("token", token)
    rest = [c for c in rows.columns if c not in ("seen_date", "source", "source_job_id", "file", "pos")]
    first = rows.groupBy("seen_date", "source", "source_job_id").agg(F.min_by(F.struct(*rest), F.struct("file", "pos")).alias("r")).select("seen_date", "source", "source_job_id", "r.*")
    bare = F.array_join(F.array_compact(F.array(_falls(F.col("plain"), html_to_text(F.col("body"))), F.nullif(html_to_text(F.col("lists")), F.lit("")), F.col("more"))), "\n\n")
    text = F.when(F.col("escaped").isNotNull(), html_to_text(F.col("escaped"), True)).otherwise(bare)
    return first.select(
        "source", "source_job_id", "seen_date", "token", "url", "title", _falls(F.col("company"), F.col("token")).alias("company"), "location", "location_extra", "country_code", "department", "posted_date",
        text.alias("raw_text"), "salary", stable_id(F.col("source"), F.col("source_job_id")).alias("job_id"),
    )


def active_only(rows: DataFrame, active: DataFrame, keys: tuple[str, ...] = ("source", "token")) -> DataFrame:
    """The rows whose keys are in `active`, exactly as written; the rows of removed companies are dropped before anything else is done with them."""
    return rows.join(active.select(*keys).distinct(), list(keys), "left_semi")


def _counted(df: DataFrame, write) -> int:  # noqa: ANN001
    """Rows that write(df) wrote, counted on the way."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


def land(df: DataFrame, path: str, keys: list[str]) -> int:
    """Append only the rows whose keys are not there yet; the number of rows written. Landed rows are never changed, and of them only the keys are read."""
    new = df.dropDuplicates(keys)
    if exists(df.sparkSession, path):
        new = new.join(df.sparkSession.read.schema(df.schema).parquet(path).select(*keys), keys, "left_anti")
    return _counted(new, lambda x: x.write.mode("append").parquet(path))


def publish(tables: dict[str, DataFrame], path: str, text_columns: tuple[str, ...] = ("raw_text",)) -> dict[str, int]:
    """Write each table as parquet with its texts redacted; the number of rows of each, also kept as a table `meta`."""
    counts: dict[str, int] = {}
    for name, df in tables.items():
        for c in set(text_columns) & set(df.columns):
            df = df.withColumn(c, redact(F.col(c)))
        counts[name] = _counted(df, lambda x, at=f"{path}/{name}": x.write.mode("overwrite").parquet(at))
    spark = next(iter(tables.values())).sparkSession
    spark.createDataFrame(sorted(counts.items()), "name string, n_rows long").write.mode("overwrite").parquet(f"{path}/meta")
    return counts


def first_complete(spark: SparkSession, roots: list[str], names: list[str]) -> dict[str, DataFrame] | None:
    """The tables of the first root that has all of them, each <root>/<name>; None if none has."""
    for root in roots:
        if all(exists(spark, f"{root}/{n}") for n in names):
            return {n: spark.read.parquet(f"{root}/{n}") for n in names}
    return None


def read_evaluations(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The last evaluation of each model among the files evaluation_*.json of a folder, by file name; broken files are skipped."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    raw = spark.read.option("pathGlobFilter", "evaluation_*.json").text(path, wholetext=True).select(name.alias("file"), F.from_json("value", schema).alias("r"))
    return raw.where("r.model is not null").groupBy("r.model").agg(F.max_by("r", "file").alias("r")).select("r.*")


def append_incremental(spark: SparkSession, rows: DataFrame, path: str, keys: list[str]) -> int:
    """Append rows (computed by rules) whose keys, version included, are not stored yet: a second run writes none, a new version all."""
    return land(rows, path, keys)


def log_metrics(metrics: DataFrame, path: str, day: str, force: bool = False) -> bool:
    """Keep (metric, value) of a day once; a day that is there is left alone unless `force`, which replaces it. Was anything written?"""
    spark = metrics.sparkSession
    at = f"{path}/day={day}"
    if exists(spark, at) and not force:
        return False
    metrics.select("metric", "value").write.mode("overwrite").parquet(at)
    return True


def rules_from_json(text: str) -> tuple[tuple[str, str], ...]:
    """Ordered pattern rules from their configuration: [{"name": ..., "patterns": [...]}, ...]; the patterns of a stage are alternatives."""
    return tuple((r["name"], "|".join(r["patterns"])) for r in json.loads(text) if r.get("patterns"))
