"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.sources.tables import shared_dir, stored


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label) for each node of `edges` (src, dst): label is the least node of its component.

    Alternating large-star and small-star rounds: each one is an aggregation
    with partial minima and an equi-join, so a hub with a third of all edges
    is pre-aggregated before its shuffle and its join side is split by AQE.
    Chains halve in each round. Every round is written to the shared folder,
    which cuts the lineage and survives the loss of an executor.

    Nulls, loops and repeated edges are dropped; an empty table gives an empty one.
    """
    base = shared_dir(edges.sparkSession)

    def normal(df: DataFrame) -> DataFrame:
        return df.where("src is not null and dst is not null and src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()

    now = stored(normal(edges), f"{base}/0")
    state = None
    for i in range(1, max_rounds + 1):
        both = now.unionByName(now.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
        large = both.where("dst > src").join(low, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        large = large.where("src <> dst").distinct()
        down = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = large.join(down, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).where("src <> dst").unionByName(down.select("src", F.col("m").alias("dst")))
        now = stored(normal(small), f"{base}/{i}")
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(20,0)"))).first()
        if new == state or not new[0]:
            break
        state = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("src").alias("node"), F.col("dst").alias("label")).unionByName(now.select(F.col("dst").alias("node"), F.col("dst").alias("label")).distinct())
