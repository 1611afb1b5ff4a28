"""What is kept of an extracted record: only values the posting's own text proves."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions.rules import ROLE_RULES, enum_or
from postmill.functions.text import numbers_in

# Levels, kinds of work and pay periods that a record may name.
LEVELS = ("intern", "junior", "mid", "senior", "lead", "manager", "unknown")
FAMILIES = tuple(sorted({n for n, _ in ROLE_RULES} | {"Other tech"}))
PERIODS = ("hour", "day", "month", "year")
PAY = ("salary_min", "salary_max", "salary_currency", "salary_period", "salary_text")


def rules_version(code: str, *configurations: object) -> str:
    """A version that changes by itself with the rules it was made from."""
    return f"{code}-{hashlib.sha1(repr(configurations).encode()).hexdigest()[:6]}"


def _squeezed(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"\s+", " "))


def pay_verdict(salary_min: Column, salary_max: Column, salary_text: Column, raw_text: Column) -> Column:
    """'none' without a number; 'proved' if the quoted words stand in the text (case and blanks apart) and all numbers in the words; else 'rejected'."""
    quote = F.trim(F.coalesce(salary_text, F.lit("")))
    quoted = (quote != "") & F.coalesce(F.contains(_squeezed(raw_text), _squeezed(quote)), F.lit(False))
    found = numbers_in(quote)
    told = lambda v: v.isNull() | F.array_contains(found, v)
    return F.when(salary_min.isNull() & salary_max.isNull(), "none").when(quoted & told(salary_min) & told(salary_max), "proved").otherwise("rejected")


def clean(records: DataFrame) -> DataFrame:
    """`records` (role_family, seniority, the pay columns, raw_text, ...) with what isn't proved blanked.

    Unknown levels and families become the default, unknown periods null. Pay
    that isn't proved is blanked whole, and so are words without numbers;
    proved bounds in the wrong order are swapped. NaN counts as null. Adds
    salary_rejected and salary_stated; other columns stay.
    """
    number = lambda c: F.when(~F.isnan(c), F.col(c))
    x = records.withColumns({"salary_min": number("salary_min"), "salary_max": number("salary_max")})
    x = x.withColumn("_v", pay_verdict(F.col("salary_min"), F.col("salary_max"), F.col("salary_text"), F.col("raw_text")))
    kept = F.col("_v") == "proved"
    turned = F.col("salary_min") > F.col("salary_max")
    low, high = F.when(turned, F.col("salary_max")).otherwise(F.col("salary_min")), F.when(turned, F.col("salary_min")).otherwise(F.col("salary_max"))
    return x.withColumns({
        "role_family": F.coalesce(enum_or(F.col("role_family"), FAMILIES, "Other tech"), F.lit("Other tech")),
        "seniority": F.coalesce(enum_or(F.col("seniority"), LEVELS, "unknown"), F.lit("unknown")),
        "salary_min": F.when(kept, low), "salary_max": F.when(kept, high), "salary_currency": F.when(kept, F.col("salary_currency")),
        "salary_period": F.when(kept, enum_or(F.col("salary_period"), PERIODS, None)), "salary_text": F.when(kept, F.col("salary_text")),
        "salary_rejected": F.col("_v") == "rejected", "salary_stated": kept,
    }).drop("_v")


def first_spellings(names: Column) -> Column:
    """Array of names: trimmed, blank ones dropped, of those that differ in case only the first spelling, by their lower case."""
    tidy = F.filter(F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))
    firsts = F.filter(tidy, lambda x, i: F.array_position(F.transform(tidy, lambda y: F.lower(y)), F.lower(x)) == i + 1)
    return F.transform(F.array_sort(F.transform(firsts, lambda x: F.struct(F.lower(x).alias("k"), x.alias("v")))), lambda s: s["v"])
