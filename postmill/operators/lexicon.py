"""Which entries of a list of names a text mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions import rules
from postmill.sources.tables import spread


def words(c: Column) -> Column:
    """Words of letters, digits, + and #, as written; no word for a text without any."""
    return F.filter(F.split(F.regexp_replace(c, "[^0-9A-Za-z+#]+", " "), " "), lambda w: w != "")


def lexicon_names(names: DataFrame, entry: str) -> DataFrame:
    """(entry, w, exact): the words of each name as they must stand in a text.

    Names of up to two characters are matched as they are written, names that
    are plain words too with a capital, all others in any case; words that
    mean nothing alone are left out, and so are names without a word.
    """
    x = names.where("name is not null").select(entry, words(F.col("name")).alias("w")).where("size(w) > 0")
    whole = F.array_join("w", " ")
    low = F.lower(whole)
    capital = low.isin(rules.CAPITAL_ONLY.split())
    exact = (F.length(whole) <= rules.EXACT_UP_TO) | capital
    written = F.when(capital, F.concat(F.upper(F.substring(whole, 1, 1)), F.expr("substring(array_join(w, ' '), 2)"))).when(exact, whole).otherwise(low)
    return x.where(~low.isin(rules.NEVER_ALONE.split())).select(entry, F.split(written, " ").alias("w"), exact.alias("exact")).distinct()


def named_entries(texts: DataFrame, names: DataFrame, key: str, entry: str) -> DataFrame:
    """(key, entry) of each mention in `texts` (key, text) of a name in `names` (entry, name); repeated mentions may repeat.

    Every word of a text is one row with its followers, as many as the longest
    name needs, and is joined with the names by its first word: no run of
    words is built as a string, and the list side is left to the size check of
    adaptive execution. Null texts and names have no mention.
    """
    n = lexicon_names(names, entry)
    longest = n.agg(F.max(F.size("w"))).first()[0]
    if longest is None:
        return texts.limit(0).select(key).join(names.limit(0).select(entry), F.lit(False))
    t = spread(texts.where("text is not null").select(key, "text")).select(key, words(F.col("text")).alias("t"))
    rest = [F.slice("t", F.lit(i + 1), F.greatest(F.size("t") - i, F.lit(0))).alias(f"w{i}") for i in range(longest)]
    at = t.select(key, F.explode(F.array_distinct(F.arrays_zip(*rest))).alias("x"))
    run = F.array(*[F.col(f"x.w{i}") for i in range(longest)])
    at = at.select(key, F.lower("x.w0").alias("first"), run.alias("run"))
    n = n.select(entry, F.lower(F.col("w")[0]).alias("first"), "w", "exact")
    here = F.slice("run", F.lit(1), F.size("w"))
    return at.join(n, "first").where(F.when(F.col("exact"), here == F.col("w")).otherwise(F.transform(here, lambda x: F.lower(x)) == F.col("w"))).select(key, entry)
