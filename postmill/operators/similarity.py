"""Near-duplicate groups by an exact set-similarity join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.functions.text import company_key, shingle_hashes, title_key
from postmill.operators.components import connected_components
from postmill.sources.tables import shared_dir, spread, stored

SAME_TITLE, ANY_TITLE = 0.8, 0.95


def text_classes(posts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of a company with the same shingle set are one class; (members, sets).

    members (job_id, company_key, title_key, class_id), sets (company_key,
    class_id, titles, toks). Rows without shingles are a class of their own per
    company and title. The class id is the smallest job_id in it. Null
    companies and titles count as empty; rows with a null job_id are dropped;
    repeated rows count once.
    """
    base = shared_dir(posts.sparkSession)
    p = spread(posts.where("job_id is not null")).select("job_id", F.coalesce(company_key("company"), F.lit("")).alias("company_key"), F.coalesce(title_key("title"), F.lit("")).alias("title_key"), F.array_sort(shingle_hashes(F.col("raw_text"))).alias("toks"))
    p = p.withColumn("form", F.when(F.size("toks") > 0, F.concat_ws(":", F.size("toks"), F.xxhash64("toks"), F.hash("toks"))).otherwise(F.concat(F.lit("t:"), "title_key")))
    p = stored(p, f"{base}/shingled")  # the shingles are computed once
    keys = p.select("job_id", "company_key", "title_key", "form").distinct()
    ids = keys.groupBy("company_key", "form").agg(F.min("job_id").alias("class_id"), F.collect_set("title_key").alias("titles"))
    members = stored(keys.join(ids.drop("titles"), ["company_key", "form"]).select("job_id", "company_key", "title_key", "class_id"), f"{base}/members")
    # the row whose id names the class brings its set; no set of another copy is shuffled
    sets = p.where("size(toks) > 0").select("company_key", "form", "toks", F.col("job_id").alias("class_id")).join(ids, ["company_key", "form", "class_id"], "inner")
    sets = sets.dropDuplicates(["company_key", "class_id", "form"]).select("company_key", "class_id", "titles", "toks")
    return members, stored(sets, f"{base}/sets")


def class_links(sets: DataFrame) -> DataFrame:
    """(company_key, class_a, class_b, similarity) of the linked classes, smaller id first.

    Linked are classes of one company with Jaccard of at least 0.95, or of 0.8
    with a title in common. Shingles are ordered by their rarity in the
    company; only the n - ceil(0.8 n) + 1 rarest of a set are joined, which
    loses no pair, and a shared shingle counts only if what follows it in both
    sets can still make up the overlap. Copies were collapsed to classes
    before, so a group of equal texts is one row here however large it is;
    whole sets are fetched for the pairs that are left.
    """
    base = shared_dir(sets.sparkSession)
    # company and shingle are one number; a chance collision only brings a pair that isn't verified
    node = F.xxhash64("company_key", "class_id")
    toks = sets.select(node.alias("node"), F.size("toks").alias("n"), F.explode(F.transform("toks", lambda t: F.xxhash64("company_key", t))).alias("h"))
    counts = toks.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # a shingle of one text only joins nothing, but it comes first in the order
    often = toks.join(counts, "h").groupBy("node").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "h"))).alias("s"))
    single = F.col("n") - F.size("s")
    keep = F.greatest(F.lit(0), F.col("n") - F.ceil(F.col("n") * SAME_TITLE) + 1 - single).cast("int")
    prefix = often.select("node", "n", single.alias("single"), F.posexplode(F.slice("s", F.lit(1), keep)).alias("at", "x"))
    prefix = stored(prefix.select("node", "n", F.col("x.h").alias("h"), (F.col("n") - F.col("single") - F.col("at")).alias("left")), f"{base}/prefix")  # left: this shingle and those after it
    a, b = (prefix.select("h", F.col("node").alias(f"node_{s}"), F.col("n").alias(f"n{s}"), F.col("left").alias(f"left_{s}")) for s in "ab")
    enough = F.least("left_a", "left_b") >= F.ceil(SAME_TITLE / (1 + SAME_TITLE) * (F.col("na") + F.col("nb")) - 1e-9)
    near = a.join(b, "h").where("node_a < node_b and least(na, nb) >= 0.8 * greatest(na, nb)").where(enough).select("node_a", "node_b").distinct()
    full = near
    for s in "ab":
        full = full.join(sets.select(node.alias(f"node_{s}"), F.col("company_key").alias(f"c{s}"), F.col("class_id").alias(f"k{s}"), F.col("toks").alias(f"t{s}"), F.col("titles").alias(f"l{s}")), f"node_{s}")
    common = F.size(F.array_intersect("ta", "tb"))
    full = full.where("ca = cb").withColumn("similarity", common / (F.size("ta") + F.size("tb") - common))
    full = full.where((F.col("similarity") >= ANY_TITLE) | ((F.col("similarity") >= SAME_TITLE) & F.arrays_overlap("la", "lb")))
    return full.select(F.col("ca").alias("company_key"), F.least("ka", "kb").alias("class_a"), F.greatest("ka", "kb").alias("class_b"), "similarity")


def near_duplicate_groups(posts: DataFrame) -> DataFrame:
    """(job_id, group_id, n_links): the transitive group of each posting, named by its smallest job_id, and the number of other classes its own class is linked to.

    A job_id delivered under two companies or texts has a row for each group it is in.
    """
    members, sets = text_classes(posts)
    links = stored(class_links(sets), f"{shared_dir(posts.sparkSession)}/links")
    name = lambda c: F.concat(c, F.lit("\x01"), "company_key")
    labels = connected_components(links.select(name("class_a").alias("src"), name("class_b").alias("dst")))
    degree = links.select(F.explode(F.array(name("class_a"), name("class_b"))).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    m = members.select("job_id", "class_id", name("class_id").alias("node")).distinct()
    out = m.join(labels, "node", "left").join(degree, "node", "left")
    return out.select("job_id", F.coalesce(F.substring_index("label", "\x01", 1), "class_id").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
