"""Labels set by people and machines: which one holds, and what a new one changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_state(sample: DataFrame, labels: DataFrame, drafts: DataFrame, fields: dict[str, str], key: str = "job_id") -> DataFrame:
    """Each row of `sample` with the values that hold: those of its label, else of its draft, else the defaults in `fields` (SQL literals); `origin` tells which.

    A label counts as a whole, null values included. Keys repeated in labels or
    drafts must have been settled before (`upsert`).
    """
    cols = list(fields)
    pick = lambda df, name: df.select(key, F.struct(*cols).alias(name))
    x = sample.join(pick(labels, "_label"), key, "left").join(pick(drafts, "_draft"), key, "left")
    held = F.coalesce("_label", "_draft", F.struct(*[F.expr(v).alias(c) for c, v in fields.items()]))
    origin = F.when(F.col("_label").isNotNull(), "label").when(F.col("_draft").isNotNull(), "draft").otherwise("default")
    return x.select(*sample.columns, *[held[c].alias(c) for c in cols], origin.alias("origin"))


def _plain(c: str, kind: str):  # noqa: ANN202
    """Lists are compared without their order."""
    return F.sort_array(c) if kind.startswith("array") else F.col(c)


def upsert(labels: DataFrame, changes: DataFrame, drafts: DataFrame, fields: list[str], key: str = "job_id", order: str = "seq") -> DataFrame:
    """`labels` after `changes`: (key, fields, labeler, human_edited, changed_fields), one row a key.

    Of several changes of a key the one with the greatest `order` holds. It is
    compared with the label before, or the draft where there was none; what
    differs is kept in changed_fields, and once edited a label stays so, with
    the fields that were changed first where the new one changes nothing. A
    label whose origin was a machine says so in `labeler` for good.
    """
    kinds = {f.name: f.dataType.simpleString() for f in changes.schema}
    new = changes.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*fields), order).alias("new"))
    old = labels.select(key, F.struct(*fields).alias("old"), "labeler", "human_edited", "changed_fields")
    x = new.join(old, key, "full").join(drafts.select(key, F.struct(*fields).alias("draft")), key, "left")
    base = F.coalesce("old", "draft")
    differs = F.array_compact(F.array(*[F.when(~_plain(f"new.{c}", kinds[c]).eqNullSafe(_plain(f"base.{c}", kinds[c])), F.lit(c)) for c in fields]))
    x = x.withColumn("base", base).withColumn("diff", F.when(F.col("new").isNotNull(), differs).otherwise(F.array().cast("array<string>")))
    machine = F.col("draft").isNotNull() | F.coalesce(F.startswith("labeler", F.lit("machine")), F.lit(False))
    return x.select(
        key, *[F.coalesce("new", "old")[c].alias(c) for c in fields],
        F.when(F.col("new").isNull(), F.col("labeler")).when(machine, "machine+human").otherwise("human").alias("labeler"),
        ((F.size("diff") > 0) | F.coalesce("human_edited", F.lit(False))).alias("human_edited"),
        F.when(F.size("diff") > 0, F.col("diff")).otherwise(F.coalesce("changed_fields", F.array().cast("array<string>"))).alias("changed_fields"),
    )
