"""What changed between consecutive full snapshots of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PRESENCE = "\x00present"


def latest_delivery(snaps: DataFrame, number: str, key: str, delivered: str, fields: list[str]) -> DataFrame:
    """One row per snapshot and key: the one delivered last.

    A delivery without a time is the oldest; between equal times the row with
    the greatest values holds, so that the result doesn't depend on the order
    of the input. Rows without key or number are dropped.
    """
    row = F.struct(F.col(delivered).alias("at"), *[F.col(f).alias(f) for f in fields])
    return snaps.where(F.col(key).isNotNull() & F.col(number).isNotNull()).groupBy(F.col(number).alias("n"), F.col(key).alias("k")).agg(F.max(row).alias("r")).select("n", "k", *[F.col("r")[f].alias(f) for f in fields])


def snapshot_diff(snaps: DataFrame, fields: list[str], number: str = "snapshot_no", key: str = "job_id", delivered: str = "delivered_at") -> DataFrame:
    """(snapshot_no, key, change_kind, changed_fields) between each snapshot and the one before it.

    Each row is unpivoted into one cell per field and a presence marker. The
    cells count +1 in the row's own snapshot and -1 in the next one present;
    what doesn't cancel within (snapshot, key, field, value) is a difference.
    A presence that is left means added (+1) or removed (-1); only other cells
    left means changed, and their fields are the changed ones.

    Rows that are the same in both cancel before they are unpivoted, as all
    their cells would. The sums are taken inside one hash partitioning by (snapshot, key): the
    unpivot never crosses the network, and a key has at most two rows there,
    however often it was delivered. Null equals null. The first snapshot is
    compared with nothing and gives no row. Only the table of distinct
    snapshot numbers is windowed as a whole.
    """
    rows = latest_delivery(snaps, number, key, delivered, fields)
    numbers = snaps.where(F.col(key).isNotNull() & F.col(number).isNotNull()).select(F.col(number).alias("n")).distinct()
    order = Window.orderBy("n")
    numbers = numbers.select("n", F.lead("n").over(order).alias("next_n"), F.lag("n").over(order).isNull().alias("is_first"))
    out = rows.join(numbers, "n")
    signed = out.select(F.explode(F.array(F.struct(F.when(~F.col("is_first"), F.col("n")).alias("s"), F.lit(1).alias("sign")), F.struct(F.col("next_n").alias("s"), F.lit(-1).alias("sign")))).alias("e"), "k", *fields)
    signed = signed.select("e.s", "e.sign", "k", *fields).where("s is not null").repartition("s", "k")
    # a row that stands the same in both snapshots cancels as a whole, before it is unpivoted
    signed = signed.groupBy("s", "k", *fields).agg(F.sum("sign").alias("sign")).where("sign <> 0")
    cell = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]
    cells = signed.select("s", "k", "sign", F.explode(F.array(F.struct(F.lit(PRESENCE).alias("field"), F.lit(None).cast("string").alias("value")), *cell)).alias("c"))
    left = cells.groupBy("s", "k", "c.field", "c.value").agg(F.sum("sign").alias("net")).where("net <> 0")
    present = F.coalesce(F.max(F.when(F.col("field") == PRESENCE, F.col("net"))), F.lit(0))
    return left.groupBy("s", "k").agg(present.alias("p"), F.array_sort(F.collect_set(F.when(F.col("field") != PRESENCE, F.col("field")))).alias("f")).select(
        F.col("s").alias(number), F.col("k").alias(key),
        F.when(F.col("p") > 0, "added").when(F.col("p") < 0, "removed").otherwise("changed").alias("change_kind"),
        F.when(F.col("p") == 0, F.col("f")).otherwise(F.array().cast("array<string>")).alias("changed_fields"),
    )
