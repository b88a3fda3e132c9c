"""Classification rules of catalogue items as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _holds(words: Sequence[str]):
    return lambda label: F.greatest(*[F.contains(F.lower(label), F.lit(w)) for w in words], F.lit(False))


def first_group(labels: Column, groups: Sequence[tuple[str, Sequence[str]]], otherwise: str = "other") -> Column:
    """The first group any of whose words is in any label; labels is an array."""
    out = F.lit(otherwise)
    for name, words in reversed(groups):
        hit = F.exists(labels, _holds(words))
        out = F.when(hit, name).otherwise(out)
    return out


def first_reason(rules: Sequence[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds, or null."""
    return F.coalesce(*[F.when(rule, F.lit(name)) for name, rule in rules])


def first_word(text: Column, words: Sequence[str], prefix: str) -> Column:
    """prefix and the first of the words, in their order, that the text holds; or null."""
    return F.concat(F.lit(prefix), F.get(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(text, w)), F.lit(0)))


def decade(year: Column, floor: int) -> Column:
    """"pre-" and the floor for earlier years, else the decade."""
    return F.when(year < floor, f"pre-{floor}").otherwise(F.concat((F.floor(year / 10) * 10).cast("string"), F.lit("s")))


def series_status(is_tv: Column, end_year: Column, no_end: Column) -> Column:
    """Struct of status and the evidence for it; both null for films."""
    ended = F.coalesce(end_year != 0, F.lit(False))
    status = F.when(ended & no_end, "unknown").when(ended, "ended").when(no_end, "ongoing").otherwise("unknown")
    basis = F.when(ended & no_end, "conflict").when(ended, "P582").when(no_end, "P582_novalue").otherwise("none")
    return F.struct(F.when(is_tv, status).alias("status"), F.when(is_tv, basis).alias("basis"))


def single_id(values: Column) -> Column:
    """Struct of the one distinct positive number of an array of strings, or null, and whether there are several."""
    ids = F.array_distinct(F.filter(F.transform(values, lambda v: F.floor(v.try_cast("double")).try_cast("long")), lambda x: x > 0))
    return F.struct(F.when(F.size(ids) == 1, F.get(ids, F.lit(0))).alias("id"), (F.size(ids) > 1).alias("ambiguous"))


def season_count(value: Column) -> Column:
    """A whole number from 1 to 100, else null."""
    n = value.try_cast("double")
    return F.when((n == F.floor(n)) & n.between(1, 100), n.cast("int"))


def language_basis(languages: Column, countries: Column, is_tv: Column, names: Mapping[str, str], home: Mapping[str, Sequence[str]], order: Sequence[str], fallback: tuple[str, str]) -> Column:
    """Struct of the language that decides an item's bucket (null: world) and the rule that found it.

    names: language -> named language ("english" or one of order); home: named language -> its countries;
    fallback: the country and language of series without any language."""
    pairs = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*map(F.lit, names.values())))
    named = F.array_distinct(F.filter(F.transform(languages, lambda x: pairs[x]), lambda x: x.isNotNull()))
    other = F.exists(languages, lambda x: pairs[x].isNull())
    at_home = F.filter(named, lambda n: F.coalesce(*[F.when(n == k, F.arrays_overlap(countries, F.array(*map(F.lit, v)))) for k, v in home.items()], F.lit(False)))
    first = lambda a: F.get(F.filter(F.array(*map(F.lit, order)), lambda x: F.array_contains(a, x)), F.lit(0))
    english = lambda a: F.array_contains(a, "english")
    country, language = fallback
    pick = lambda value, basis: F.struct(value.cast("string").alias("language"), F.lit(basis).alias("basis"))
    none = F.lit(None)
    rule = F.when(F.size(languages) == 0, F.when(F.array_contains(countries, country) & is_tv, pick(F.lit(language), "no_language_country_only")).otherwise(pick(none, "no_language")))
    rule = rule.when(F.size(named) == 0, pick(none, "no_named_language")).when((F.size(named) == 1) & ~other, pick(F.get(named, F.lit(0)), "only_language"))
    rule = rule.when(F.size(at_home) == 1, pick(F.get(at_home, F.lit(0)), "country_of_origin")).when(english(at_home), pick(F.lit("english"), "co_production_english"))
    rule = rule.when(F.size(at_home) > 0, pick(first(at_home), "country_of_origin_fixed_order")).when(F.size(countries) > 0, pick(none, "no_language_matches_country"))
    return rule.when(english(named), pick(F.lit("english"), "no_country_english_listed")).otherwise(pick(first(named), "no_country_fixed_order"))


def version(text: Column) -> Column:
    """A dotted version as an array of numbers, which compares part by part; [0] if any part is no number."""
    parts = F.transform(F.split(text, r"\."), lambda x: x.try_cast("int"))
    return F.when(text.isNull() | F.exists(parts, lambda x: x.isNull()), F.array(F.lit(0))).otherwise(parts)


def license_for(stamp: Column) -> Column:
    """The license of a revision by its ISO time."""
    return F.when(stamp >= "2023-06-29T00:00:00Z", "CC-BY-SA-4.0").otherwise("CC-BY-SA-3.0")
