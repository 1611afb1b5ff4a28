"""Queries on containers (p6_...) and mixtures (p7_...) of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm.mixing import mix
from postmill.llm.packing import fill_report, pack
from postmill.llm.token_sizes import token_sizes
from postmill.sources.tables import shared_dir, stored, table


def _capacities(spark: SparkSession, sf_dir: str) -> dict[int, int]:
    return {r["spec_id"]: r["capacity_tokens"] for r in table(spark, sf_dir, "container_spec").where("spec_id is not null and capacity_tokens > 0").collect()}


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = token_sizes(table(spark, sf_dir, "documents"))
    return pack(sizes, _capacities(spark, sf_dir))


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_report(p6_containers(spark, sf_dir), _capacities(spark, sf_dir))


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sizes = stored(token_sizes(table(spark, sf_dir, "documents"), keep=("source",)), f"{shared_dir(spark)}/sizes")
    return mix(sizes, table(spark, sf_dir, "mix_target"))


def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)[0]


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _mixed(spark, sf_dir)[1]
    return s.select("source", "target_share", "max_repeats", "available_tokens", "drawn_tokens", F.round("actual_share", 5).alias("actual_share"), "n_pages", F.round("due_copies", 3).alias("due_copies"), "n_copies", "limited")


QUERIES = {"p6_containers": p6_containers, "p6_fill": p6_fill, "p7_mixture": p7_mixture, "p7_shares": p7_shares}
SQL: dict[str, str] = {}
