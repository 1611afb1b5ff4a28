"""Ordered pattern rules as column expressions: the first rule that matches decides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Title patterns in their order; a family may come again with broader patterns.
ROLE_RULES = (
    ("SA", r"system[s]? analyst|solution[s]? analyst|it business analyst|application specialist|people tech(nology)? analyst"),
    ("BA", r"business analyst|insights analyst|strategy (&|and) analytics|product operations analyst"),
    ("Product", r"product (manager|owner)"),
    ("DS/ML", r"data scien(tist|ce)|applied scientist|research scientist|machine learning|\bai\s*/\s*ml\b|\bai (engineer|scientist)\b|\bllm\b"),
    ("DA", r"data analyst|\bbi\b|business intelligence"),
    ("Data Eng", r"data engineer|analytics engineer|data platform"),
    ("Software Eng", r"software (engineer|developer|engineering)|devops|\bsre\b|security (engineer|analyst|operation|architect)"),
    ("DA", r"analytics|analyst"),
    ("Software Eng", r"software|developer|engineer|architect|technical lead|tech lead|\bqa\b"),
)
# Levels named in titles, the highest first.
LEVEL_RULES = (
    ("intern", r"\bintern(ship)?s?\b|accelerator program"),
    ("manager", r"\bhead of\b|\bdirector\b|\bengineering manager\b|\b(senior|lead) manager\b|^[^0-9A-Za-z_]*manager\b"),
    ("lead", r"\blead\b|\bstaff\b|\bprincipal\b"),
    ("senior", r"\bsenior\b|\bsr\.?\s|\bassociate manager\b"),
    ("junior", r"\bjunior\b|\bassociate\b|\bnew grad(uate)?\b|\bgraduate\b"),
)
# Places of one country, as they occur in locations.
HOME_PLACES = r"thailand|bangkok|\bbkk\b|chiang mai|phuket|pattaya|chonburi|rayong|nonthaburi|samut prakan|กรุงเทพ|ไทย"
# Names that are also plain words: counted with a capital only; never counted by themselves.
CAPITAL_ONLY = "swift react node ruby spark hive"
NEVER_ALONE = "c agents lambda algorithms spring regression rest api experimentation spreadsheets"
# Other names of spoken languages.
LANGUAGE_ALIASES = {"mandarin": "Chinese", "chinese (mandarin)": "Chinese", "thai": "Thai", "english": "English"}
#: Names of at most so many characters must be written exactly.
EXACT_UP_TO = 2
#: A number of years, also as a span ("3-5 years") or with a plus.
YEARS = r"(\d{1,2})(?:\s*\+|\s*-\s*\d+\+?)?\s*\+?\s*years?"
#: The word must lie within 100 characters of the number, with all of its own.
NEAR = 100 - len("experience")


def first_match(c: Column, rules: tuple[tuple[str, str], ...], default: str) -> Column:
    """Name of the first rule whose pattern occurs in c, in any case; the default for null and for no match."""
    out = None
    for name, pattern in rules:
        hit = c.rlike("(?i)" + pattern)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(default)


def role_family(title: Column) -> Column:
    return first_match(title, ROLE_RULES, "Other tech")


def title_level(title: Column) -> Column:
    return first_match(title, LEVEL_RULES, "unknown")


def level(title: Column, text: Column) -> Column:
    """The level of the title; where it has none, of the most years (under 30) that stand within 100 characters of 'experience'."""
    # Only the number is consumed, so one 'experience' serves all years around it.
    before = F.regexp_extract_all(text, F.lit(rf"(?is)(?<=experience.{{0,{NEAR}}}){YEARS}"), F.lit(1))
    after = F.regexp_extract_all(text, F.lit(rf"(?is){YEARS}(?=.{{0,{NEAR}}}?experience)"), F.lit(1))
    years = F.filter(F.transform(F.concat(before, after), lambda x: x.try_cast("int")), lambda y: y < 30)
    most = F.array_max(years)
    by_years = F.when(most < 2, "junior").when(most < 5, "mid").when(most.isNotNull(), "senior").otherwise("unknown")
    named = title_level(title)
    return F.when(named != "unknown", named).otherwise(by_years)


def at_home(country: Column, *places: Column) -> Column:
    """In the country by its code, or by a place named in any of the columns; false where all are null."""
    return F.coalesce(country == "TH", F.lit(False)) | F.coalesce(F.concat_ws(" | ", *places).rlike("(?i)" + HOME_PLACES), F.lit(False))


def home_first(location: Column, more: Column, country: Column) -> Column:
    """One place only, and at home: several places are told by a semicolon or the word 'or'."""
    several = location.rlike(r"(?i);|\bor\b")
    alone = (country == "TH") & ~F.coalesce(F.contains(more, F.lit(";")), F.lit(False))
    return F.coalesce(~several, F.lit(True)) & (F.coalesce(location.rlike("(?i)" + HOME_PLACES), F.lit(False)) | F.coalesce(alone, F.lit(False)))


def enum_or(c: Column, allowed: tuple[str, ...], default: str | None) -> Column:
    return F.when(c.isin(*allowed), c).otherwise(F.lit(default))


def spoken_language(c: Column) -> Column:
    """A language by its usual name: known aliases in any case, others with capitals after spaces; null for blank ones."""
    t = F.trim(c)
    out = F.initcap(t)
    for alias, name in LANGUAGE_ALIASES.items():
        out = F.when(F.lower(t) == alias, name).otherwise(out)
    return F.nullif(out, F.lit(""))
